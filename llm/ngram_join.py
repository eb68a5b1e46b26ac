"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of shingles of five words (lower-cased, without punctuation; a shorter text is one shingle).  Every text
has ``VALUES`` MinHash values of 16 bits.  Two texts are candidates if all ``ROWS`` values of one of the bands agree:
at similarity 0.8 they miss each other with a chance of 5e-8.  Values of a candidate pair are then compared
``STEP`` at a time.  With a uniform prior on the similarity, ``m`` agreements in ``n`` values give a beta posterior; the
pair is dropped as soon as the posterior chance of reaching the threshold is below ``TOLERANCE``.  What is left is
verified by the exact Jaccard similarity of the shingle sets.

Equal texts are one text with a number of copies.  Candidate pairs are never listed: the tasks of a bucket return a
spanning forest of the pairs that survive, its components are compared in blocks (see ``pairs``), again candidates
first, pruned and verified, and the tasks return the number of links of each text and a forest of the verified ones.
So a group of thousands of copies costs comparisons, spread over tasks, but no rows.

Defined cases: texts without words (NULL, empty) have no shingles, link to nothing and are classes of their own; rows
equal in id and text are two copies; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import Windows, byte_windows, given_id, identified, lowered, mix, packed, pieces, plain_words, stored
from llm.graph import components
from llm.pairs import Forest, block_tasks, sides, spread_blocks, streamed_groups

SHINGLE = 5
THRESHOLD = 0.8
ROWS, BANDS = 4, 32
VALUES = ROWS * BANDS
STEP = 16
TOLERANCE = 1e-9
BLOCK = 128
SEED = 11
COLUMNS = 1 << 15  # shingles of a task compared at a time

_SKETCH = "did long, tkey long, words long, shingles long, bands array<long>"


def shingle_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the shingles of all rows, shingles before each row, and words before each row."""
    low = lowered(data)
    starts, ends, before = plain_words(low, offsets)
    hashes = byte_windows(low).of(starts, ends)
    n = np.diff(before)
    many = np.where(n > 0, np.maximum(n - SHINGLE + 1, 1), 0)
    upto = np.concatenate([[0], np.cumsum(many)])
    at = np.repeat(before[:-1] - upto[:-1], many) + np.arange(upto[-1])
    return Windows(hashes, 1).of(at, np.minimum(at + SHINGLE, np.repeat(before[1:], many))), upto, before


def _min_hashes(shingles: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """``VALUES`` 16-bit MinHash values of each row that has shingles."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    factors = (mix(np.arange(1, VALUES + 1, dtype=np.uint64) + np.uint64(SEED)) | np.uint64(1)).astype(np.uint32)
    first = upto[:-1][np.diff(upto) > 0]
    out = np.empty((len(first), VALUES), np.uint16)
    for k, factor in enumerate(factors):
        low = np.minimum.reduceat((short ^ factor) * factor, first)
        out[:, k] = (low * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in pieces(batches):
        shingles, upto, before = shingle_hashes(data, offsets)
        count = np.diff(upto)
        bands = np.zeros((len(batch), BANDS), np.int64)
        if len(shingles):
            bands[count > 0] = np.ascontiguousarray(_min_hashes(shingles, upto)).view(np.int64)
        listed = pa.ListArray.from_arrays(np.arange(0, (len(batch) + 1) * BANDS, BANDS, dtype=np.int32), pa.array(bands.ravel()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(np.diff(before)), pa.array(count), listed],
            names=[c.split()[0] for c in _SKETCH.split(", ")],
        )


@lru_cache(4)
def fewest_agreements(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[int, ...]:
    """For ``STEP, 2 * STEP, ...`` values: the fewest agreements with a chance of ``threshold`` of at least ``tolerance``.

    The posterior after ``m`` agreements in ``n`` is Beta(m + 1, n - m + 1); its mass above the threshold is a binomial
    sum.  Values of 16 bits agree by chance once in 65,536, which only makes a pair stay.
    """
    from math import comb

    def above(m: int, n: int) -> float:
        return sum(comb(n + 1, i) * threshold**i * (1 - threshold) ** (n + 1 - i) for i in range(m + 1))

    return tuple(next(m for m in range(n + 1) if above(m, n) >= tolerance) for n in range(STEP, VALUES + 1, STEP))


def _pruned(values: np.ndarray, i: np.ndarray, j: np.ndarray, least: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    agree = np.zeros(len(i), np.int64)
    for k, needed in enumerate(least):
        part = slice(k * STEP, (k + 1) * STEP)
        agree += (values[i, part] == values[j, part]).sum(1)
        stay = agree >= needed
        i, j, agree = i[stay], j[stay], agree[stay]
    return i, j


def _across(left: np.ndarray, right: np.ndarray, close: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs marked in ``close``, each once."""
    if len(left) == len(right) and np.array_equal(left, right):
        close = np.triu(close, 1)
    i, j = np.nonzero(close)
    return left[i], right[j]


def candidates(values: np.ndarray, left: np.ndarray, right: np.ndarray, least: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (of rows of ``values``) across ``left`` and ``right`` that share a band and survive the pruning."""
    bands = np.ascontiguousarray(values).view(np.int64).reshape(len(values), BANDS)
    close = np.zeros((len(left), len(right)), bool)
    for k in range(BANDS):
        close |= bands[left, k][:, None] == bands[right, k][None, :]
    return _pruned(values, *_across(left, right, close), least)


def _values(table: pa.Table) -> np.ndarray:
    return table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS).view(np.uint16)


def _bucket(least: tuple[int, ...]):
    """Forest of the surviving pairs of a bucket that share no earlier band: each pair is compared in one bucket."""

    def forest(table: pa.Table) -> list[tuple]:
        values, band = _values(table), table.column("band")[0].as_py()
        bands = values.view(np.int64)
        left, right = sides(table)
        i, j = _across(left, right, bands[left, band][:, None] == bands[right, band][None, :])
        for k in range(band):
            new = bands[i, k] != bands[j, k]
            i, j = i[new], j[new]
        ids, found = table.column("id").to_pylist(), Forest(len(table))
        i, j = _pruned(values, i, j, least)
        for a, b in zip(i.tolist(), j.tolist()):
            found.union(a, b)
        return found.stars(ids)

    return forest


def _sizes_of_overlap(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Shared shingles of the pairs ``(i, j)``: few pairs one by one, many by products of slices of the incidence matrix."""
    if len(i) < 64:
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j)], np.int64)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(column[-1]) + 1, COLUMNS):
        a, b = np.searchsorted(column, (at, at + COLUMNS))
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[rows[a:b], column[a:b] - at] = 1
        shared += part @ part.T
    return shared[i, j].astype(np.int64)


def _verify(threshold: float, least: tuple[int, ...]):
    """Links and forest of a task: ``(id, other, links)``; a row of links has no other."""
    percent = round(threshold * 1_000_000)

    def verified(table: pa.Table) -> list[tuple]:
        ids = table.column("id").to_numpy()
        once = np.unique(ids, return_index=True)[1]
        if len(once) < len(ids):  # rows equal in id and text
            table = table.take(pa.array(np.sort(once)))
        ids, copies = table.column("id").to_pylist(), table.column("copies").to_pylist()
        i, j = candidates(_values(table), *sides(table), least)
        if not len(i):
            return []
        used, back = np.unique(np.concatenate([i, j]), return_inverse=True)
        a, b = back[: len(i)], back[len(i) :]
        sets = []
        for _, data, offsets in pieces(table.select(["text"]).take(pa.array(used)).to_batches()):
            shingles, upto, _ = shingle_hashes(data, offsets)
            sets += [np.unique(shingles[s:e]) for s, e in zip(upto[:-1], upto[1:])]
        shared = _sizes_of_overlap(sets, a, b)
        size = np.array([len(s) for s in sets])
        near = shared * 1_000_000 >= percent * (size[a] + size[b] - shared)
        links, found = np.zeros(len(used), np.int64), Forest(len(used))
        for x, y in zip(a[near].tolist(), b[near].tolist()):
            links[x] += copies[used[y]]
            links[y] += copies[used[x]]
            found.union(x, y)
        own = [ids[k] for k in used]
        rows = [(own[x], None, int(n)) for x, n in enumerate(links) if n]
        return rows + [(a, b, 0) for a, b in found.stars(own)]

    return verified


def similar_texts(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(did, tkey, class_id, class_key, n_links)`` of every row: links are the rows, copies included, at or above the threshold.

    The class is the connected component; it goes by its smallest id and, where rows share that id, the smallest key.
    """
    least = fewest_agreements(threshold)
    named = identified(docs)
    sketch = stored(named.mapInArrow(_sketch, _SKETCH), "sketch")
    # Equal texts are one; it goes by the hash of its text, and its words tell apart the texts without any.
    full = sketch.where("shingles > 0")
    texts = stored(
        full.groupBy("tkey").agg(F.min("did").alias("did"), F.count("*").alias("copies"), F.first("bands").alias("bands")), "texts"
    ).withColumnRenamed("tkey", "id")
    rows = texts.select("id", F.posexplode("bands").alias("band", "value"))
    shared = rows.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1")
    members = rows.join(shared, ["band", "value"]).join(texts.select("id", "bands"), "id")
    forest = streamed_groups(spread_blocks(members, "id", BLOCK), ["band", "value", "bi", "bj"], _bucket(least), "a long, b long")
    near = components(forest, "near")
    roots = near.unionByName(near.select(F.col("root").alias("id"), "root").distinct())
    # Blocks are laid out before the texts come in, so that each text moves once.
    placed = block_tasks(roots.join(texts, "id"), "root", "id", BLOCK).alias("p")
    placed = placed.join(named.alias("n"), (F.col("p.did") == F.col("n.did")) & (F.col("p.id") == F.col("n.tkey")))
    placed = placed.select("root", "bi", "bj", "own", "id", "copies", "bands", "text")
    found = stored(
        streamed_groups(placed, ["root", "bi", "bj"], _verify(threshold, least), "id long, other long, links long"), "verified", release=True
    )
    links = found.where("other IS NULL").groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(found.where("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b")), "classes")
    known = texts.select("id", "did", "copies").join(links, "id", "left").join(joined, "id", "left")
    known = known.withColumn("root", F.coalesce("root", "id"))
    smallest = known.groupBy("root").agg(F.min(F.struct("did", "id")).alias("least"))
    classes = known.join(smallest, "root").select(
        F.col("id").alias("tkey"), F.col("least.did").alias("class_id"), F.col("least.id").alias("class_key"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    out = sketch.select("did", "tkey").join(classes, "tkey", "left")
    return out.select(
        "did", "tkey", F.coalesce("class_id", "did").alias("class_id"), F.coalesce("class_key", "tkey").alias("class_key"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without near copies: of each class one row with the smallest id stays."""
    kept = similar_texts(docs, threshold).where("did = class_id AND tkey = class_key").select("did", "tkey").distinct()
    first = F.row_number().over(Window.partitionBy("did", "tkey").orderBy("did"))
    return packed(docs).join(kept, ["did", "tkey"], "left_semi").withColumn("nth", first).where("nth = 1").select("doc.*")


def op5(docs: DataFrame) -> DataFrame:
    found = similar_texts(docs)
    return found.select(given_id(F.col("did")).alias("doc_id"), given_id(F.col("class_id")).alias("class_id"), "n_links")
