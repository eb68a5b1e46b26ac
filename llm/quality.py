"""Quality rules with tokeniser fertility.

Public vocabularies measure each text: a byte-level BPE (``tiktoken`` ranks) gives characters per token and the entropy
of its tokens, a piece model with byte fallback gives the share of tokens that are single bytes.  Text in a script or
language that a vocabulary was made for has few tokens; noise, keys, encodings and wrong scripts break into many, into
bytes, or into few kinds of token.  A text is rejected where a measure leaves the band of its language, or else of its
script.  Texts of fewer than ``MIN_WORDS`` words, or made of repeated word triples, fail by the base rules.

Bands come from the corpus: the quartiles of each measure over all texts that pass the base rules, per language and
script, and per script for languages of fewer than ``LEAST`` texts.  A bound lies ``FENCE`` times the quartiles' distance
beyond them, and at least a fixed part from the median, so that a corpus of mostly copies does not narrow it to nothing.
Only where a script has too few texts as well do the fixed bands below hold.  Characters per token have no upper bound
of the corpus: text that a vocabulary knows better than the rest is no junk.

Each distinct word of a piece of rows is tokenised once, with the space before it, and the counts are put together per
row; words never share tokens, so the parts add up.  Words are those between white space.  One pass for the measures,
and quartiles that combine before the shuffle; the pipeline's stage measures its texts again rather than store them.

Defined cases: NULL and empty texts have no words and fail; an unknown or NULL language falls to the script's band;
a text without letters belongs to script ``other``.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from llm.common import Windows, byte_windows, mix, pieces, rows_of, spaced_words, stored

TOKENIZERS = "/opt/tokenizers"
RANKS, PIECES = "byte_bpe_multi_50k.tiktoken", "piece_bpe_32k.model"
MIN_WORDS = 50
PIECE = 1 << 20  # bytes of text that share one table of words
REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Band:
    """What a text may measure: characters per token, entropy of tokens as a share of its highest value, byte share."""

    chars_low: float
    chars_high: float
    entropy_low: float
    bytes_high: float


LEAST = 100  # texts that make quartiles
FENCE = 3.0
LEAST_PARTS = (0.95, 0.8, 0.10)  # characters and entropy, as parts of the median; byte share, above the median

# For tables too small for quartiles, by language first, then by script.  Wide: they turn away what no writer produces.
LANGUAGE_BANDS = {
    "en": Band(1.5, 8.0, 0.45, 0.10), "de": Band(1.4, 8.0, 0.45, 0.10),
    "fr": Band(1.3, 8.0, 0.45, 0.10), "es": Band(1.4, 8.0, 0.45, 0.10),
}
SCRIPT_BANDS = {
    "latin": Band(1.2, 9.0, 0.40, 0.20), "greek_cyrillic": Band(0.7, 9.0, 0.40, 0.30),
    "other_letters": Band(0.3, 9.0, 0.35, 0.90), "other": Band(0.8, 9.0, 0.40, 0.30),
}
# First bytes of UTF-8 letters: ASCII letters and U+00C0-024F (C3-C9), Greek and Cyrillic (CD-D3), all beyond.
_LATIN, _GREEK, _BEYOND = (np.zeros(256, bool) for _ in range(3))
_LATIN[65:91] = _LATIN[97:123] = _LATIN[0xC3:0xCA] = True
_GREEK[0xCD:0xD4] = True
_BEYOND[0xD4:0xF5] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_chars_token double, "
    "token_entropy double, byte_share double, base_failed boolean"
)
_JUDGED = ("n_chars_token", "token_entropy", "byte_share", "base_failed")
_KINDS = {"string": StringType(), "double": DoubleType(), "boolean": BooleanType()}


@lru_cache(2)
def _vocabularies(folder: str):
    """Both vocabularies, with the bytes of each rank, and which pieces are single bytes or begin a word."""
    import sentencepiece
    import tiktoken

    with open(f"{folder}/{RANKS}", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    sizes[list(ranks.values())] = [len(x) for x in ranks]
    encoding = tiktoken.Encoding("words", pat_str=r"\x20[^\x20]*", mergeable_ranks=ranks, special_tokens={})
    model = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{PIECES}")
    ids = range(model.vocab_size())
    is_byte = np.array([model.is_byte(i) for i in ids])
    begins = np.array([model.id_to_piece(i).startswith("\u2581") for i in ids])
    return encoding, sizes, model, is_byte, begins


def _tokens(words: list[bytes], encoding, sizes) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all words, each with a space before it, and where each word's begin."""
    ids = np.array(encoding.encode_ordinary(b" ".join([b"", *words]).decode()), np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    return ids, np.searchsorted(np.concatenate([[0], np.cumsum(sizes[ids])]), np.concatenate([[0], np.cumsum(lengths)]))


def _pieces(words: list[bytes], model, begins) -> tuple[np.ndarray, np.ndarray]:
    """The same for the piece model, which writes the space before a word into its first piece."""
    groups = [b" ".join(words[i : i + 512]).decode() for i in range(0, len(words), 512)]
    ids = np.array([t for x in model.encode(groups, num_threads=1) for t in x], np.int64)
    at = np.flatnonzero(begins[ids])
    if len(at) == len(words):
        return ids, np.append(at, len(ids))
    each = model.encode([w.decode() for w in words], num_threads=1)  # a word holds the mark of the space itself
    lengths = np.fromiter(map(len, each), np.int64, len(each))
    return np.array([t for x in each for t in x], np.int64), np.concatenate([[0], np.cumsum(lengths)])


def _group_sums(values: np.ndarray, before: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[before[1:]] - sums[before[:-1]]


def _again(keys: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of (row, key) pairs in order: whether the pair occurs twice or more, and whether it occurred before."""
    both = mix(keys + rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(both, kind="stable")
    both = both[order]
    same = np.zeros(len(order), bool)
    same[1:] = both[1:] == both[:-1]
    many = same.copy()
    many[:-1] |= same[1:]
    twice, earlier = np.zeros(n, bool), np.zeros(n, bool)
    twice[order], earlier[order] = many, same
    return twice, earlier


def base_measures(data: np.ndarray, offsets: np.ndarray):
    """The five counts of each row, with the words' bounds and hashes."""
    starts, ends, before = spaced_words(data, offsets)
    rows = rows_of(before)
    windows = byte_windows(data)
    hashes = windows.of(starts, ends)
    n_words = np.diff(before)
    characters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    word_chars = _group_sums(characters[ends] - characters[starts], before)
    n_symbols = _group_sums(_SYMBOL[data], offsets)
    # Lines: cut at \n and at row ends; those with a word count.
    breaks = np.flatnonzero(data == 10)
    line_start = np.concatenate([offsets[:-1], breaks + 1])
    line_end = np.concatenate([breaks, offsets[1:]])
    line_start.sort(kind="stable")
    line_end.sort(kind="stable")
    line_row = np.searchsorted(offsets[1:], line_start, "right")
    has_word = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_start, line_end, line_row = line_start[has_word], line_end[has_word], line_row[has_word]
    _, seen = _again(windows.of(line_start, line_end), line_row, len(line_start))
    n_dup_lines = np.bincount(line_row[seen], minlength=len(offsets) - 1)
    # Word triples that occur twice or more in the row; the words they cover.
    at = np.flatnonzero(rows[2:] == rows[:-2]) if len(rows) > 2 else np.zeros(0, np.int64)
    twice, _ = _again(Windows(hashes).of(at, at + 3), rows[at], len(at))
    covered = np.zeros(len(rows) + 3, bool)
    for k in range(3):
        covered[at[twice] + k] = True
    n_repeat = _group_sums(covered[: len(rows)], before)
    return (starts, ends, before, rows, hashes), (n_words, word_chars, n_symbols, n_dup_lines, n_repeat)


def fertility(data: np.ndarray, words, word_chars: np.ndarray, folder: str):
    """Characters per token, relative entropy of tokens and byte share of each row."""
    starts, ends, before, rows, hashes = words
    encoding, sizes, model, is_byte, begins = _vocabularies(folder)
    n, vocabulary = len(before) - 1, len(sizes)
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    raw = data.tobytes()
    distinct = [raw[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist())]
    tokens, cut = _tokens(distinct, encoding, sizes)
    own, own_cut = _pieces(distinct, model, begins)
    n_tokens = _group_sums(np.diff(cut)[which], before)
    n_pieces = _group_sums(np.diff(own_cut)[which], before)
    n_bytes = _group_sums(_group_sums(is_byte[own], own_cut)[which], before)
    # Every token of every word with its row, sorted: runs give the counts.
    size = np.diff(cut)[which]
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    keys = np.sort(np.repeat(rows, size) * vocabulary + tokens[np.repeat(cut[which], size) + inside])
    edge = np.flatnonzero(np.diff(keys, prepend=-1))
    counts = np.diff(np.append(edge, len(keys)))
    key_row = keys[edge] // vocabulary
    total = np.bincount(key_row, weights=counts, minlength=n)
    kinds = np.bincount(key_row, minlength=n)
    surprise = np.bincount(key_row, weights=counts * np.log2(np.maximum(counts, 1)), minlength=n)
    with np.errstate(divide="ignore", invalid="ignore"):
        entropy = np.log2(total) - surprise / total
        highest = np.log2(np.minimum(total, vocabulary))
        relative = np.where(total > 1, entropy / highest, 1.0)
        # A long text cannot keep a high share of distinct tokens: compare with what its kinds allow.
        relative = np.where(kinds > 1, np.maximum(relative, entropy / np.log2(np.maximum(kinds, 2)) * np.minimum(1, kinds / 64)), 0.0)
        return word_chars / n_tokens, relative, n_bytes / n_pieces


def _scripts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    counts = np.stack([_group_sums(table[data], offsets) for table in (_LATIN, _GREEK, _BEYOND)])
    names = np.array(["latin", "greek_cyrillic", "other_letters"], object)[counts.argmax(0)]
    return np.where(counts.sum(0) > 0, names, "other")


def measured(batches, folder: str) -> Iterator[pa.RecordBatch]:
    """Batches with ``text`` and ``lang`` to the same rows with script and measures after their columns but ``text``."""
    for batch, data, offsets in pieces(batches, PIECE):
        words, base = base_measures(data, offsets)
        n_words, word_chars, _, _, n_repeat = base
        shares = fertility(data, words, word_chars, folder)
        failed = (n_words < MIN_WORDS) | (100 * n_repeat > REPEAT_PERCENT * n_words)
        own = [c for i, c in enumerate(batch.columns) if batch.schema.names[i] != "text"]
        names = [n for n in batch.schema.names if n != "text"]
        made = [pa.array(_scripts(data, offsets), pa.string())]
        made += [*map(lambda x: pa.array(x.astype(np.int64)), base), *map(lambda x: pa.array(np.nan_to_num(x)), shares)]
        made += [pa.array(failed)]
        yield pa.RecordBatch.from_arrays([*own, *made], names=[*names, "script", *[c.split()[0] for c in MEASURES.split(", ")]])


def _measures(docs: DataFrame, folder: str) -> DataFrame:
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string"))
    return narrow.mapInArrow(lambda it: measured(it, folder), f"doc_id long, lang string, script string, {MEASURES}")


def fences(measures: DataFrame, *keys: str) -> DataFrame:
    """``(*keys, bounds)``: the bounds that the corpus gives each group of at least ``LEAST`` texts."""
    names = ("n_chars_token", "token_entropy", "byte_share")
    quartiles = [F.percentile_approx(c, [0.25, 0.5, 0.75], 10_000).alias(c) for c in names]
    groups = measures.where(~F.col("base_failed")).dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("_n"), *quartiles)
    low = lambda c, part: F.least(F.col(c)[0] - FENCE * (F.col(c)[2] - F.col(c)[0]), part * F.col(c)[1])
    share = F.col("byte_share")
    high = F.greatest(share[2] + FENCE * (share[2] - share[0]), share[1] + LEAST_PARTS[2])
    bounds = F.struct(
        low("n_chars_token", LEAST_PARTS[0]).alias("chars_low"), low("token_entropy", LEAST_PARTS[1]).alias("entropy_low"), high.alias("bytes_high")
    )
    return groups.where(F.col("_n") >= LEAST).select(*keys, bounds.alias(f"__by_{keys[0]}"))


def corpus_fences(measures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bounds by language and script, and by script: few rows, as many as there are languages in four scripts."""
    return stored(fences(measures, "lang", "script"), "fences"), stored(fences(measures, "script"), "fences")


def _fits(language_bands: dict[str, Band], name: str, script: str, lang: str, fitted: bool) -> Column:
    """Whether the measure lies in its band: that of the corpus if ``fitted`` and there is one, else the fixed one."""

    def fixed(field: str) -> Column:
        table = lambda bands, c: F.create_map(*[F.lit(x) for k, b in bands.items() for x in (k, float(getattr(b, field)))])[F.col(c)]
        own = [table(language_bands, lang)] if language_bands else []
        return F.coalesce(*own, table(SCRIPT_BANDS, script))

    bound = lambda field: F.coalesce(F.col(f"__by_lang.{field}"), F.col(f"__by_script.{field}"), fixed(field)) if fitted else fixed(field)
    n = lambda c: F.col(name + c)
    return (
        (n("n_chars_token") >= bound("chars_low")) & (n("n_chars_token") <= fixed("chars_high"))
        & (n("token_entropy") >= bound("entropy_low")) & (n("byte_share") <= bound("bytes_high"))
    )


def quality_rules(docs: DataFrame, folder: str = TOKENIZERS, language_bands: dict[str, Band] | None = None) -> DataFrame:
    """``doc_id`` and all measures and verdicts of each row of ``docs``; given bands hold in place of the corpus's."""
    rows, fitted = _measures(docs, folder), language_bands is None
    if fitted:
        rows = stored(rows, "measures")
        by_lang, by_script = corpus_fences(rows)
        rows = rows.join(F.broadcast(by_lang), ["lang", "script"], "left").join(F.broadcast(by_script), "script", "left")
    kept = ~F.col("base_failed") & _fits(LANGUAGE_BANDS if fitted else language_bands, "", "script", "lang", fitted)
    return rows.select("doc_id", *[c.split()[0] for c in MEASURES.split(", ")], kept.alias("kept"))


def accepted(docs: DataFrame, folder: str = TOKENIZERS, language_bands: dict[str, Band] | None = None) -> DataFrame:
    """The rows of ``docs`` that the rules keep, unchanged."""
    if not {"text", "lang"} <= set(docs.columns):
        return docs
    fitted = language_bands is None
    made = ["lang string", "script string", *[c for c in MEASURES.split(", ") if c.split()[0] in _JUDGED]]

    def measure(batches):
        for batch in batches:
            two = batch.select(["text", "lang"])
            two = two.set_column(1, "lang", two.column(1).cast(pa.string()))
            own = pa.Table.from_batches(list(measured([two], folder))).combine_chunks()
            columns = [own.column(c.split()[0]).combine_chunks() for c in made]
            columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *[f"__{c.split()[0]}" for c in made]])

    schema = StructType(docs.schema.fields + [StructField(f"__{c.split()[0]}", _KINDS[c.split()[1]]) for c in made])
    rows = docs.mapInArrow(measure, schema)
    if fitted:
        # Texts are measured twice: first for the bands, which need few numbers of each, then for their own verdict.
        narrow = docs.select(F.lit(None).cast("long").alias("doc_id"), "lang", "text")
        by_lang, by_script = corpus_fences(stored(_measures(narrow, folder).select("lang", "script", *_JUDGED), "measures"))
        own, script = by_lang.toDF("__l", "__s", "__by_lang"), by_script.toDF("__t", "__by_script")
        rows = rows.join(F.broadcast(own), (F.col("__lang") == F.col("__l")) & (F.col("__script") == F.col("__s")), "left")
        rows = rows.join(F.broadcast(script), F.col("__script") == F.col("__t"), "left")
    bands = LANGUAGE_BANDS if fitted else language_bands
    return rows.where(~F.col("__base_failed") & _fits(bands, "__", "__script", "__lang", fitted)).select(*docs.columns)


def op9(docs: DataFrame) -> DataFrame:
    return quality_rules(docs)
