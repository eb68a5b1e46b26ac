"""Benchmark decontamination with a distributed positional inverted index, in DataFrame operations only.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in lower case.  A window is 13 consecutive words of
an item; a shorter item is one window.  The corpus is counted once for the terms of the benchmark.  Each window is
looked up by its two rarest terms: the index holds their postings ``(term, document, position)``, the position less the
term's offset in the item gives a diagonal, and where both lists meet on a diagonal the window may occur.  Only then is
the document read, once, and its words are held against the item's along its diagonals, which gives the exact phrase
matches.  ``proximity_matches`` intersects the same lists with some slack.

Windows of an item share terms, so an item has few lookups.  A term that the corpus lacks rules its windows out.
Postings are kept for the looked-up terms alone; frequent terms are looked up only where a window has no others.
The pass that finds them also counts each document's words, and only texts with a candidate are read again: the others
never move.  Terms and candidates are small or large as they are; Spark broadcasts them by the size of their files.

Lists are built with ``lower`` and one form of sigma, whose lower case depends on what follows, on both sides; the last
comparison folds A-Z only.

Defined cases: NULL and empty texts have no words and no hits; items without words have no windows; rows of a benchmark
that share an id are one item with the windows of both; NULL item ids are left out; an empty benchmark hits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import given_id, identified, packed, stored

WINDOW = 13
LOOKED_UP = 2  # rarest terms of a window; ``candidates`` relies on there being two at most
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # of lower-cased text
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Part of a text's words that makes it contaminated: a twentieth.
SHARE = 20


def words(text: Column) -> Column:
    """Words with A-Z in lower case."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def folded_words(text: Column) -> Column:
    """The same words, as many and in the same order, with all letters in lower case: much faster to make."""
    return F.regexp_extract_all(folded(text), F.lit(WORD), F.lit(0))


def folded(text: Column) -> Column:
    """Lower case in which a letter's form does not depend on the letters beside it."""
    return F.replace(F.lower(text), F.lit("\u03c2"), F.lit("\u03c3"))


def _items(benchmark: DataFrame) -> DataFrame:
    """``(item, row, words)`` of items that have words; ``row`` tells rows of one item apart."""
    listed = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text").cast("string")).alias("words"))
    return listed.where("item IS NOT NULL AND size(words) > 0").distinct().withColumn("row", F.xxhash64("item", "words"))


def lookups(items: DataFrame, named: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(row, item, probe, terms, place, term)``: the rarest terms of each window with their places in the item."""
    placed = items.select("row", "item", F.size("words").alias("n"), F.posexplode("words").alias("place", "word"))
    placed = stored(placed.select("row", "item", "n", "place", folded(F.col("word")).alias("term")), "items")
    vocabulary = stored(placed.select("term").distinct(), "vocabulary")
    corpus = named.select(F.explode(folded_words(F.col("text"))).alias("term"))
    counts = stored(corpus.join(vocabulary, "term").groupBy("term").count(), "counts")
    # A place belongs to the windows that start at most 12 places before it.
    begin = F.explode(F.sequence(F.greatest(F.lit(0), F.col("place") - window + 1), F.least(F.col("place"), F.greatest(F.lit(0), F.col("n") - window))))
    known = placed.join(counts, "term").select("row", "item", "n", "place", "term", "count", begin.alias("begin"))
    rarest = F.slice(F.sort_array(F.collect_list(F.struct("count", "place", "term"))), 1, LOOKED_UP)
    whole = known.groupBy("row", "item", "begin", "n").agg(F.count("*").alias("found"), rarest.alias("rarest"))
    whole = whole.where(F.col("found") == F.least("n", F.lit(window)))
    probe = F.transform("rarest", lambda r: F.struct(r["place"].alias("place"), r["term"].alias("term")))
    probes = whole.select("row", "item", F.array_sort(probe).alias("probe")).distinct()
    probes = probes.select("row", "item", F.xxhash64("row", "probe").alias("probe"), F.size("probe").alias("terms"), F.explode("probe").alias("at"))
    return stored(probes.select("row", "item", "probe", "terms", "at.place", "at.term"), "probes")


def postings(named: DataFrame, terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(term, did, tkey, position)`` of ``terms`` in all documents, and ``(did, tkey, n_words)`` of every row."""
    listed = named.select("did", "tkey", folded_words(F.col("text")).alias("words"))
    spread = listed.select("did", "tkey", F.size("words").alias("n_words"), F.posexplode_outer("words").alias("position", "word"))
    known = stored(terms.select("term").distinct(), "terms")
    first = F.coalesce(F.col("position"), F.lit(0)) == 0  # also the one row of a text without words
    kept = spread.join(known, F.col("word") == F.col("term"), "left").where(F.col("term").isNotNull() | first)
    kept = stored(kept.select("did", "tkey", "position", "term", F.when(first, F.col("n_words")).cast("long").alias("n_words")), "postings")
    return kept.where("term IS NOT NULL").select("term", "did", "tkey", "position"), kept.where("n_words IS NOT NULL").select("did", "tkey", "n_words")


def _diagonals(lists: DataFrame, probes: DataFrame) -> DataFrame:
    return lists.join(probes, "term").select("row", "item", "probe", "terms", "place", "did", "tkey", (F.col("position") - F.col("place")).alias("diagonal"))


def candidates(lists: DataFrame, probes: DataFrame) -> DataFrame:
    """``(did, tkey, row, diagonal)`` where all looked-up terms of a window meet."""
    met = _diagonals(lists, probes).groupBy("row", "probe", "terms", "did", "tkey", "diagonal").agg(
        F.min("place").alias("first"), F.max("place").alias("last")
    )
    return met.where("terms = 1 OR first < last").select("did", "tkey", "row", "diagonal").distinct()


def proximity_matches(docs: DataFrame, benchmark: DataFrame, slack: int = 5) -> DataFrame:
    """``(doc_id, item_id, n)``: how often the rarest terms of an item's windows stand ``slack`` words from their distance.

    Diagonals are put into cells of twice the slack, on two grids half a cell apart; terms within the slack share a cell
    of one of them.
    """
    named, size = identified(docs), 2 * slack + 1
    probes = lookups(_items(benchmark), named)
    rows = _diagonals(postings(named, probes)[0], probes)
    cells = F.array(*[F.struct(F.lit(g).alias("grid"), F.floor((F.col("diagonal") + g * slack) / size).alias("cell")) for g in (0, 1)])
    # A cell has at most as many entries as diagonals and terms.
    met = rows.withColumn("at", F.explode(cells)).groupBy("item", "probe", "terms", "did", "tkey", "at").agg(
        F.sort_array(F.collect_set(F.struct("diagonal", "place"))).alias("entries")
    )
    pairs = F.zip_with(
        F.col("entries"), F.slice("entries", 2, F.greatest(F.lit(1), F.size("entries"))),
        lambda a, b: (a["place"] != b["place"]) & (b["diagonal"] - a["diagonal"] <= slack),
    )
    near = met.where((F.col("terms") == 1) | F.exists(pairs, lambda p: F.coalesce(p, F.lit(False))))
    near = near.select("item", "probe", "did", "tkey", F.get("entries", F.lit(0))["diagonal"].alias("low")).distinct()
    return near.groupBy(given_id(F.col("did")).alias("doc_id"), F.col("item").alias("item_id")).agg(F.count("*").alias("n"))


def phrase_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(did, tkey, n_words, n_hit, items)`` of every row of ``docs``: words inside windows, and ids of items found."""
    named = identified(docs)
    items = stored(_items(benchmark), "words")
    probes = lookups(items, named, window)
    lists, sizes = postings(named, probes)
    found = stored(candidates(lists, probes), "candidates")
    read = named.join(found.select("did", "tkey").distinct(), ["did", "tkey"], "left_semi").dropDuplicates(["did", "tkey"])
    listed = found.join(items, "row").groupBy("did", "tkey").agg(F.collect_list(F.struct("item", "diagonal", "words")).alias("found"))
    joined = read.join(listed, ["did", "tkey"]).select("did", "tkey", "found", words(F.col("text")).alias("own"))

    def starts(c: Column) -> Column:
        """Places in the document where a window of the item stands on the diagonal."""
        long = F.least(F.size(c["words"]), F.lit(window))
        places = F.sequence(F.greatest(F.lit(0), -c["diagonal"]), F.least(F.size(c["words"]), F.size("own") - c["diagonal"]) - long)
        fits = F.least(F.size(c["words"]), F.size("own") - c["diagonal"]) - long >= F.greatest(F.lit(0), -c["diagonal"])
        same = F.filter(places, lambda p: F.slice("own", p + c["diagonal"] + 1, long) == F.slice(c["words"], p + 1, long))
        return F.when(fits, F.transform(same, lambda p: p + c["diagonal"])).otherwise(F.array().cast("array<int>"))

    matched = F.transform("found", lambda c: F.struct(c["item"].alias("item"), F.least(F.size(c["words"]), F.lit(window)).alias("long"), starts(c).alias("starts")))
    matched = F.filter(matched, lambda m: F.size(m["starts"]) > 0)
    hit = joined.select("did", "tkey", matched.alias("m"))
    covered = F.flatten(F.transform("m", lambda m: F.flatten(F.transform(m["starts"], lambda s: F.sequence(s, s + m["long"] - 1)))))
    hits = hit.select(
        "did", "tkey", F.size(F.array_distinct(covered)).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.transform("m", lambda m: m["item"]))).alias("items"),
    )
    none = F.array().cast("array<string>")
    return sizes.join(stored(hits, "hits"), ["did", "tkey"], "left").select(
        "did", "tkey", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", none).alias("items")
    )


def contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (SHARE * n_hit >= n_words)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, unchanged."""
    bad = phrase_matches(docs, benchmark).where(contaminated(F.col("n_hit"), F.col("n_words"))).select("did", "tkey").distinct()
    return packed(docs).join(bad, ["did", "tkey"], "left_anti").select("doc.*")


def op4(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = phrase_matches(docs, benchmark)
    return found.select(
        given_id(F.col("did")).alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
win AS (SELECT DISTINCT item, least(len(ws), 13) AS k, list_slice(ws, i, i + least(len(ws), 13) - 1) AS win
  FROM (SELECT item, ws, unnest(range(1, greatest(2, len(ws) - 11))) AS i FROM b WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT k FROM win),
occ AS (SELECT doc_id, k, i, list_slice(ws, i, i + k - 1) AS win
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, lens WHERE len(ws) >= k)),
hit AS (SELECT o.doc_id, o.k, o.i, n.item FROM occ o JOIN win n ON o.win = n.win),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(COALESCE(n_hit, 0) AS BIGINT) AS n_hit,
 CAST(COALESCE(n_items, 0) AS BIGINT) AS n_items, sha256(COALESCE(items, '')) AS items_sha256,
 COALESCE(n_hit, 0) > 0 AND 20 * COALESCE(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
