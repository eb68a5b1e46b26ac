"""Suffix-array dedup by merging the Burrows-Wheeler transforms of shards.

Every byte covered by a string of ``LENGTH`` bytes that also starts elsewhere is removed.

*Symbols.*  Texts are cut where the text itself says so: at hashes of ``GRAM`` bytes that are smaller than all within
``REACH`` positions.  Equal strings are cut alike, but for their ends, so the pieces serve as symbols, over ``REACH`` bytes
each and about twice that.  Symbols that occur once end every repeat, so only stretches of repeated symbols go on.

*Shards.*  A shard sorts the suffixes of its own stretches and holds its suffix array and transform.

*Merge.*  The interleave of all shards is refined one symbol at a time, without sorting the suffixes again: where row ``r``
stands in a block of equal prefixes of ``h`` symbols, the row it maps to by its transform's symbol stands in the block
named by that symbol and the block of ``r``.  Shards send the names of their blocks with their sizes, packed by bucket,
and hear how large each block is in all shards.  A row whose block holds it alone has met its longest common prefix and
rests; the others go on until they span ``LENGTH`` bytes and what stands around.  So only repeated intervals live on, and
copies in one shard are one block with a size.

*Bytes.*  A window is a repeat for certain if the symbols inside it and those that cover it have intervals of one size, at
least two: whatever shares the inside shares the window.  It is none if the inside occurs once.  In between, at the edges
of repeats, and where a text has too few cuts, as in one letter over and over, windows are compared whole, by 96 bits.

Nothing holds more than a shard, a bucket or a text; shards and buckets have a fixed size and grow in number.

Defined cases: NULL texts are empty; texts of fewer than ``LENGTH`` bytes keep all; rows equal in id and text count as two
places, so both lose what they share; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import byte_windows, given_id, identified, mix, pieces, runs, stored
from llm.substring import _MESSAGE, _REPLY, _messages, _widened, answers, by_bucket, gathered, packed_rows, places_of, unpacked

LENGTH = 400
REACH = 24
GRAM = 16
SHARD_BYTES = 16 << 20
BUCKET_BYTES = 48 << 20
DEPTHS, MESSAGES, COUNTS = 0, 1, 2

_STRETCH = "shard long, did long, tkey long, place int, symbols binary, sizes binary"
_SHARD = "shard long, dids binary, tkeys binary, places binary, lengths binary, symbols binary, sizes binary, suffixes binary"
_STATE = "kind int, shard long, bucket int, depth int, payload binary"
_INTERVALS = "did long, tkey long, place int, depths binary, counts binary"


class Cuts:
    """Cuts of the rows of a piece: ``at`` their places, ``row`` of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, windows):
        n = len(data) - GRAM + 1
        self.at = self.row = np.zeros(0, np.int64)
        lengths = np.diff(offsets)
        if n <= 2 * REACH or lengths.max() < LENGTH:
            return
        grams = mix((windows.sums[GRAM : n + GRAM] - windows.sums[:n]) * windows.inverse[:n])
        low = grams
        for step in (1, 2, 4, 8):
            low = np.minimum(low[:-step], low[step:])
        low = np.minimum(low[: len(low) - REACH + 16], low[REACH - 16 :])  # of REACH hashes from each place on
        middle = grams[REACH : n - REACH]
        # Smaller than all before: of equal ones in reach, the first.
        cut = np.flatnonzero((middle < low[: len(middle)]) & (middle <= low[REACH + 1 : REACH + 1 + len(middle)])) + REACH
        row = np.searchsorted(offsets, cut, "right") - 1
        inside = (cut - REACH >= offsets[row]) & (cut + REACH + GRAM <= offsets[row + 1]) & (lengths[row] >= LENGTH)
        self.at, self.row = cut[inside], row[inside]

    def symbols(self, windows) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash, size, row and place in its row of each symbol."""
        if len(self.at) < 2:
            none = np.zeros(0, np.int64)
            return none.astype(np.uint64), none, none, none
        here = np.flatnonzero(self.row[1:] == self.row[:-1])
        first = np.searchsorted(self.row, self.row[here])
        return windows.of(self.at[here], self.at[here + 1]), self.at[here + 1] - self.at[here], self.row[here], here - first


def _symbol_messages(buckets: int, width: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches):
            windows = byte_windows(data)
            hashes, _, rows, places = Cuts(data, offsets, windows).symbols(windows)
            dids, tkeys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            order, parts = by_bucket(hashes, buckets)
            out = []
            for p, a, b in parts:
                own = np.sort(order[a:b])
                low = hashes[own].view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
                out.append((p, low, *packed_rows(rows[own], places[own], dids, tkeys)))
            yield _messages(out)

    return emit


def _repeated_symbols(width: int, homes: int):
    def met(group: pd.DataFrame) -> pd.DataFrame:
        doc, ids, places = unpacked(group)
        hashes = _widened(b"".join(group["payload"]), width)
        order = np.argsort(hashes)
        h = hashes[order]
        same = np.zeros(len(h) + 1, bool)
        same[1:-1] = h[1:] == h[:-1]
        many = np.zeros(len(h), bool)
        many[order] = same[1:] | same[:-1]
        return answers(doc[many], ids, places[many], homes)

    return met


def _stretches(shards: int):
    """Stretches of two repeated symbols or more."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches):
            windows = byte_windows(data)
            hashes, sizes, rows, places = Cuts(data, offsets, windows).symbols(windows)
            upto = np.searchsorted(rows, np.arange(len(batch) + 1))
            dids, tkeys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            home = (mix(tkeys.view(np.uint64) + dids.view(np.uint64)) % np.uint64(shards)).astype(np.int64)
            out = []
            for row, found in enumerate(batch.column(3).to_pylist()):
                a, b = int(upto[row]), int(upto[row + 1])
                known = np.unique(places_of(found))
                known = known[known < b - a].astype(np.int64)
                cuts = np.flatnonzero(np.diff(known) > 1) + 1
                for part in np.split(known, cuts):
                    if len(part) > 1:
                        own = slice(a + int(part[0]), a + int(part[-1]) + 1)
                        out.append((int(home[row]), int(dids[row]), int(tkeys[row]), int(part[0]), hashes[own].tobytes(), sizes[own].astype(np.uint32).tobytes()))
            columns = list(zip(*out)) if out else [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in _STRETCH.split(", ")])

    return emit


def suffix_array(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffixes in order; a suffix ends with its stretch (``ends``), and a shorter one comes first.  By doubling."""
    n = len(symbols)
    _, rank = np.unique(symbols, return_inverse=True)
    rank, step, longest = rank + 1, 1, int((ends - np.arange(n)).max(initial=0))
    while step < longest and int(rank.max()) < n:
        ahead = np.arange(n) + step
        second = np.where(ahead < ends, rank[np.minimum(ahead, n - 1)], 0)
        _, rank = np.unique(rank * (n + 1) + second, return_inverse=True)
        rank, step = rank + 1, 2 * step
    return np.argsort(rank, kind="stable").astype(np.int32)


def _build(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["did", "tkey", "place"], kind="stable", ignore_index=True)
    symbols = np.frombuffer(b"".join(group["symbols"]), np.uint64)
    lengths = group["symbols"].map(len).to_numpy() // 8
    ends = np.repeat(np.cumsum(lengths), lengths)
    return pd.DataFrame({
        "shard": [group["shard"].iloc[0]], "dids": [group["did"].to_numpy().tobytes()], "tkeys": [group["tkey"].to_numpy().tobytes()],
        "places": [group["place"].to_numpy(np.int32).tobytes()], "lengths": [lengths.astype(np.int32).tobytes()],
        "symbols": [symbols.tobytes()], "sizes": [b"".join(group["sizes"])], "suffixes": [suffix_array(symbols, ends).tobytes()],
    })


class Shard:
    """A shard's rows: its suffixes in order, the transform, and the map from a row to that of the suffix one symbol longer."""

    def __init__(self, row: pd.Series):
        self.shard = int(row["shard"])
        self.lengths = np.frombuffer(row["lengths"], np.int32).astype(np.int64)
        self.symbols = np.frombuffer(row["symbols"], np.uint64)
        self.suffixes = np.frombuffer(row["suffixes"], np.int32).astype(np.int64)
        n = len(self.symbols)
        self.ends = np.repeat(np.cumsum(self.lengths), self.lengths)
        self.sums = np.concatenate([[0], np.cumsum(np.frombuffer(row["sizes"], np.uint32).astype(np.int64))])
        self.row_of = np.empty(n, np.int64)
        self.row_of[self.suffixes] = np.arange(n)
        begins = self.ends - np.repeat(self.lengths, self.lengths)
        self.from_rows = np.flatnonzero(self.suffixes > begins[self.suffixes])  # rows with a symbol before them
        self.to_rows = self.row_of[self.suffixes[self.from_rows] - 1]
        self.transform = self.symbols[self.suffixes[self.from_rows] - 1]

    def blocks(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Names of the blocks of ``depth`` symbols of all rows, and which rows are that long."""
        names, there = self.symbols[self.suffixes], np.ones(len(self.suffixes), bool)
        for _ in range(depth - 1):
            longer, long = np.zeros_like(names), np.zeros_like(there)
            longer[self.to_rows] = mix(names[self.from_rows] * np.uint64(0x9E3779B97F4A7C15) + self.transform)
            long[self.to_rows] = there[self.from_rows]
            names, there = longer, long
        return names, there

    def asked(self, depth: int, depths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows that may repeat at ``depth``, and the names of their blocks: both shorter parts repeat, and span too little."""
        at = self.suffixes
        after = np.minimum(at + 1, len(at) - 1)
        few = np.flatnonzero(
            (depths == depth - 1) & (at + depth <= self.ends[at]) & (depths[self.row_of[after]] >= depth - 1)
        )
        few = few[self.sums[at[few] + depth - 1] - self.sums[at[few]] < LENGTH + 4 * REACH]
        return few, self.blocks(depth)[0][few] if len(few) else np.zeros(0, np.uint64)


def _ask(shard: Shard, depth: int, depths: np.ndarray, buckets: int) -> list[tuple]:
    _, names = shard.asked(depth, depths)
    own, count = np.unique(names, return_counts=True)
    order, parts = by_bucket(own, buckets)
    sent = [(MESSAGES, shard.shard, p, depth, own[order[a:b]].tobytes() + count[order[a:b]].astype(np.uint32).tobytes()) for p, a, b in parts]
    return [(DEPTHS, shard.shard, -1, depth, depths.astype(np.uint16).tobytes()), *sent]


def _begin(buckets: int):
    def begin(group: pd.DataFrame) -> pd.DataFrame:
        shard = Shard(group.iloc[0])
        return pd.DataFrame(_ask(shard, 2, np.ones(len(shard.symbols), np.int64), buckets), columns=[c.split()[0] for c in _STATE.split(", ")])

    return begin


def _answer(group: pd.DataFrame) -> pd.DataFrame:
    """Sizes of the blocks of a bucket over all shards, in the order of each message."""
    names = np.concatenate([np.frombuffer(x[: len(x) // 12 * 8], np.uint64) for x in group["payload"]])
    count = np.concatenate([np.frombuffer(x[len(x) // 12 * 8 :], np.uint32) for x in group["payload"]])
    _, back = np.unique(names, return_inverse=True)
    total = np.minimum(np.bincount(back, weights=count), 0xFFFFFFFF).astype(np.uint32)[back]
    cuts = np.cumsum([len(x) // 12 for x in group["payload"]])[:-1]
    return group.assign(payload=[x.tobytes() for x in np.split(total, cuts)])


def _refine(buckets: int):
    """One round of a shard: hears the sizes of its blocks, and asks for those of one symbol more."""

    def refine(static: pd.DataFrame, news: pd.DataFrame) -> pd.DataFrame:
        columns = [c.split()[0] for c in _STATE.split(", ")]
        if not len(static) or not len(news):
            return pd.DataFrame(columns=columns)
        shard = Shard(static.iloc[0])
        old = news[news["kind"] == DEPTHS].iloc[0]
        depth, depths = int(old["depth"]), np.frombuffer(old["payload"], np.uint16).astype(np.int64)
        rows, names = shard.asked(depth, depths)
        own, back = np.unique(names, return_inverse=True)
        order, parts = by_bucket(own, buckets)
        heard = {int(b): x for b, x in zip(news["bucket"], news["payload"]) if b >= 0}
        total = np.zeros(len(own), np.uint32)
        for p, a, b in parts:
            total[order[a:b]] = np.frombuffer(heard[p], np.uint32)
        sizes = total[back]
        depths[rows[sizes > 1]] = depth
        counts = (COUNTS, shard.shard, -1, depth, sizes[sizes > 1].tobytes())
        return pd.DataFrame([*_ask(shard, depth + 1, depths, buckets), counts], columns=columns)

    return refine


def _report(static: pd.DataFrame, news: pd.DataFrame) -> pd.DataFrame:
    """Per stretch: for each symbol, how many symbols from it repeat, and the sizes of those intervals from two symbols on."""
    if not len(static) or not len(news):
        return pd.DataFrame(columns=[c.split()[0] for c in _INTERVALS.split(", ")])
    shard, row = Shard(static.iloc[0]), static.iloc[0]
    depths = np.frombuffer(news[news["kind"] == DEPTHS].iloc[0]["payload"], np.uint16).astype(np.int64)
    by_place = depths[shard.row_of]
    upto = np.concatenate([[0], np.cumsum(np.maximum(by_place - 1, 0))])
    counts = np.zeros(int(upto[-1]), np.uint32)
    for _, x in news[news["kind"] == COUNTS].iterrows():
        rows = np.flatnonzero(depths >= x["depth"])
        counts[upto[shard.suffixes[rows]] + x["depth"] - 2] = np.frombuffer(x["payload"], np.uint32)
    ends = np.cumsum(shard.lengths)
    begins = ends - shard.lengths
    return pd.DataFrame({
        "did": np.frombuffer(row["dids"], np.int64), "tkey": np.frombuffer(row["tkeys"], np.int64), "place": np.frombuffer(row["places"], np.int32),
        "depths": [by_place[a:b].astype(np.uint16).tobytes() for a, b in zip(begins, ends)],
        "counts": [counts[upto[a] : upto[b]].tobytes() for a, b in zip(begins, ends)],
    })


def repeated_intervals(stretches: DataFrame, buckets: int, partitions: int) -> DataFrame:
    """``(did, tkey, intervals)``: what the merge of the shards of ``stretches`` finds, gathered by text."""
    static = stored(stretches.groupBy("shard").applyInPandas(_build, _SHARD), "shards", release=True).repartition(partitions, "shard")
    static = static.persist(StorageLevel.DISK_ONLY)  # read each round; a lost part comes again from the stored shards
    shards = static.groupBy("shard")
    state = stored(shards.applyInPandas(_begin(buckets), _STATE), "state")
    counts = []
    while state.where(F.col("kind") == MESSAGES).limit(1).count():
        answers_ = state.where(F.col("kind") == MESSAGES).groupBy("bucket").applyInPandas(_answer, _STATE)
        news = state.where(F.col("kind") == DEPTHS).unionByName(answers_)
        state = stored(shards.cogroup(news.groupBy("shard")).applyInPandas(_refine(buckets), _STATE), "state")
        counts.append(state.where(F.col("kind") == COUNTS))
    news = state.where(F.col("kind") == DEPTHS)
    for part in counts:
        news = news.unionByName(part)
    each = stored(shards.cogroup(news.groupBy("shard")).applyInPandas(_report, _INTERVALS), "intervals", release=True)
    static.unpersist()
    return each.groupBy("did", "tkey").agg(F.collect_list(F.struct("place", "depths", "counts")).alias("intervals"))


def _windows_of(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, windows) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of windows that are repeats for certain, and of those to compare."""
    cuts = Cuts(data, offsets, windows)
    n = len(cuts.at)
    lengths = np.diff(offsets)
    many = np.maximum(lengths - LENGTH + 1, 0)
    at = np.repeat(offsets[:-1] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
    if not n:
        return at[:0], at
    first_cut = np.searchsorted(cuts.row, np.arange(len(batch)))
    depth, upto = np.zeros(n, np.int64), np.zeros(n, np.int64)
    parts, done = [], 0
    for row, found in enumerate(batch.column(batch.schema.get_field_index("intervals")).to_pylist()):
        for x in found or ():
            d = np.frombuffer(x["depths"], np.uint16).astype(np.int64)
            a = int(first_cut[row]) + x["place"]
            depth[a : a + len(d)] = d
            size = np.maximum(d - 1, 0)
            upto[a : a + len(d)] = done + np.cumsum(size) - size
            parts.append(np.frombuffer(x["counts"], np.uint32))
            done += len(parts[-1])
    sizes = np.concatenate([*parts, np.zeros(1, np.uint32)]).astype(np.int64)

    def interval(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Size of the interval of the symbols between cuts ``a`` and ``b``; 0 where it is not known to repeat."""
        long = b - a
        known = (long >= 2) & (long <= depth[a])
        return np.where(known, sizes[np.where(known, upto[a] + long - 2, len(sizes) - 1)], 0)

    a, b = np.searchsorted(cuts.at, at + REACH), np.searchsorted(cuts.at, at + LENGTH - GRAM - REACH, "right") - 1
    few = at[b - a < 2]
    inside = interval(np.minimum(a, n - 1), np.maximum(b, 0))
    keep = np.flatnonzero(inside > 1)
    at, inside = at[keep], inside[keep]
    row = np.searchsorted(offsets, at, "right") - 1
    left = np.searchsorted(cuts.at, at, "right") - 1
    right = np.minimum(np.searchsorted(cuts.at, at + LENGTH), n - 1)
    held = (left >= 0) & (cuts.row[left] == row) & (cuts.row[right] == row) & (cuts.at[right] >= at + LENGTH)
    around = np.where(held, interval(np.maximum(left, 0), right), 0)
    same = around == inside
    return at[same], np.sort(np.concatenate([at[~same], few]))


def _edge_windows(buckets: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches):
            windows, again = byte_windows(data), byte_windows(data, 1)
            _, at = _windows_of(batch, data, offsets, windows)
            dids, tkeys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            first, second = windows.of(at, at + LENGTH), again.of(at, at + LENGTH).astype(np.uint32)
            rows = np.searchsorted(offsets, at, "right") - 1
            order, parts = by_bucket(first, buckets)
            out = []
            for p, a, b in parts:
                own = np.sort(order[a:b])
                out.append((p, first[own].tobytes() + second[own].tobytes(), *packed_rows(rows[own], at[own] - offsets[rows[own]], dids, tkeys)))
            yield _messages(out)

    return emit


def _equal(homes: int):
    def equal(group: pd.DataFrame) -> pd.DataFrame:
        return answers(*_equal_windows(group), homes)

    return equal


def _equal_windows(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    first = np.concatenate([np.frombuffer(x[: len(x) // 12 * 8], np.uint64) for x in group["payload"]])
    second = np.concatenate([np.frombuffer(x[len(x) // 12 * 8 :], np.uint32) for x in group["payload"]])
    doc, ids, places = unpacked(group)
    order = np.lexsort((second, first))
    f, s = first[order], second[order]
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = (f[1:] == f[:-1]) & (s[1:] == s[:-1])
    own = order[same[1:] | same[:-1]]
    return doc[own], ids, places[own]


def _removed_runs(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Removed runs of each row, in bytes of the piece."""
    sure, _ = _windows_of(batch, data, offsets, byte_windows(data))
    rows = np.searchsorted(offsets, sure, "right") - 1
    upto = np.searchsorted(rows, np.arange(len(batch) + 1))
    out = []
    for row, found in enumerate(batch.column(batch.schema.get_field_index("places")).to_pylist()):
        own = sure[upto[row] : upto[row + 1]]
        if found:
            own = np.unique(np.concatenate([own, offsets[row] + places_of(found).astype(np.int64)]))
        out.append(runs(own, LENGTH))
    return out


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in pieces(batches):
        raw = data.tobytes()
        removed, spans, digests = [], [], []
        for row, (froms, tos) in enumerate(_removed_runs(batch, data, offsets)):
            digest, at = hashlib.sha256(), int(offsets[row])
            for a, b in zip(froms.tolist(), tos.tolist()):
                digest.update(raw[at:a])
                at = b
            digest.update(raw[at : int(offsets[row + 1])])
            removed.append(int((tos - froms).sum()))
            spans.append(len(froms))
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())],
            names=["did", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def marked_texts(docs: DataFrame) -> DataFrame:
    """``(did, tkey, text, intervals, places)``: all rows with their repeated intervals and repeated windows at edges."""
    named = identified(docs)
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards, buckets = max(8, -(-total // SHARD_BYTES)), max(8, -(-total // BUCKET_BYTES))
    width = min(8, max(4, -(-(int(total).bit_length() + 5 - int(buckets).bit_length()) // 8)))
    symbols = named.mapInArrow(_symbol_messages(buckets, width), _MESSAGE)
    known = gathered(symbols.groupBy("bucket").applyInPandas(_repeated_symbols(width, shards), _REPLY))
    stretches = named.join(known, ["did", "tkey"]).mapInArrow(_stretches(shards), _STRETCH)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    intervals = stored(repeated_intervals(stretches, buckets, partitions), "repeats")
    edges = named.join(intervals, ["did", "tkey"], "left").mapInArrow(_edge_windows(4 * buckets), _MESSAGE)
    equal = gathered(edges.groupBy("bucket").applyInPandas(_equal(shards), _REPLY))
    # A text may have equal windows and no interval: few cuts.
    return named.join(intervals, ["did", "tkey"], "left").join(equal, ["did", "tkey"], "left")


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """``(did, n_bytes, n_removed, n_spans, kept_sha256)`` of every row of ``docs``."""
    return marked_texts(docs).mapInArrow(_kept, "did long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op1(docs: DataFrame) -> DataFrame:
    return suffix_dedup(docs).select(given_id(F.col("did")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
