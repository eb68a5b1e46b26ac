"""Substring dedup by fixed-block anchors: of each repeated passage of 20 words, the first occurrence stays.

Every document is cut into non-overlapping reference blocks of ``ANCHOR`` words; a window of ``WINDOW`` words holds at
least one whole block.  The blocks are indexed by a hash, and every rolling run of ``ANCHOR`` words of every document
probes the index.  A block met by a run other than itself is an anchor.  Windows around the anchors of a document are
its candidates; all others hold no repeated block and cannot repeat.  Candidate windows are compared whole, by 96 bits,
and each is told whether the same words start earlier; runs of windows that do are the maximal repeats.

There are as many runs as words, so hashes travel packed: a message holds all hashes of one piece of a batch for one
bucket of the hash space, few bytes each, and a bucket is as large as ``BUCKET`` says, whatever the corpus.  Within a
message a hash is sent at most twice, which is all the index asks, so hot passages shrink before they move.
A hash that agrees by chance makes a candidate more, never a result.

Earlier is by id, then by place.  Defined cases: NULL ids come last; NULL and empty texts have no words; rows equal in
id and text are one document, and keep the same words; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import Windows, byte_windows, given_id, identified, mix, pieces, rows_of, runs, spaced_words

WINDOW = 20
ANCHOR = 10  # two blocks less one word fit into a window wherever it starts
BUCKET = 4 << 20  # hashes in a bucket, about
HOME_BYTES = 16 << 20

_MESSAGE = "bucket int, payload binary, dids binary, tkeys binary, counts binary, places binary"
_REPLY = "home int, dids binary, tkeys binary, counts binary, places binary"
_FOUND = "did long, tkey long, places binary"


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of all words, and words before each row."""
    starts, ends, before = spaced_words(data, offsets)
    return starts, ends, byte_windows(data).of(starts, ends), before


def rolling(before: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of all windows of ``length`` words, and the row of each."""
    rows = rows_of(before)
    at = np.flatnonzero(rows[length - 1 :] == rows[: len(rows) - length + 1]) if len(rows) >= length else np.zeros(0, np.int64)
    return at, rows[at]


def by_bucket(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Order that brings the hashes of a bucket together, and ``(bucket, from, to)`` in it.  High bits choose."""
    place = ((hashes >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)
    order = np.argsort(place, kind="stable")
    sorted_place = place[order]
    cuts = np.flatnonzero(np.diff(sorted_place, prepend=np.uint64(buckets))).tolist() if len(order) else []
    return order, [(int(sorted_place[a]), a, b) for a, b in zip(cuts, [*cuts[1:], len(order)])]


def packed_places(places: np.ndarray) -> bytes:
    """Steps from place to place, the low bytes of all before the next ones: places in order then pack to a byte or less."""
    return np.diff(places.astype(np.uint32), prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()


def places_of(raw: bytes) -> np.ndarray:
    """What :func:`packed_places` packed."""
    steps = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view(np.uint32).ravel()
    return np.cumsum(steps, dtype=np.uint32)


def packed_rows(rows: np.ndarray, places: np.ndarray, dids: np.ndarray, tkeys: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    """Places with the documents that they are of, each document once; rows are in order."""
    cut = np.flatnonzero(np.diff(rows, prepend=-1))
    counts = np.diff(np.append(cut, len(rows))).astype(np.uint32)
    return dids[rows[cut]].tobytes(), tkeys[rows[cut]].tobytes(), counts.tobytes(), packed_places(places)


def unpacked(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document numbers, and their ids and keys, of all places of a bucket; and the places."""
    join = lambda c, t: np.frombuffer(b"".join(group[c]), t)
    counts = join("counts", np.uint32)
    ids = np.stack([join("dids", np.int64), join("tkeys", np.int64)], 1)
    places = np.concatenate([np.zeros(0, np.uint32), *map(places_of, group["places"])])
    return np.repeat(np.arange(len(counts)), counts), ids, places


def answers(doc: np.ndarray, ids: np.ndarray, places: np.ndarray, homes: int) -> pd.DataFrame:
    """Places packed again, by document and by the home of documents, which is a hash of their ids."""
    home = mix(ids[:, 0].view(np.uint64) ^ mix(ids[:, 1].view(np.uint64))) % np.uint64(homes)
    order = np.lexsort((places, doc, home[doc]))
    doc, places = doc[order], places[order]
    at = home[doc]
    cut = np.flatnonzero(np.diff(at, prepend=np.uint64(homes)))
    out = []
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(doc)]):
        out.append((int(at[a]), *packed_rows(doc[a:b], places[a:b], np.ascontiguousarray(ids[:, 0]), np.ascontiguousarray(ids[:, 1]))))
    return pd.DataFrame(out, columns=[c.split()[0] for c in _REPLY.split(", ")])


def _by_document(group: pd.DataFrame) -> pd.DataFrame:
    """One row for each document of a home with all its places."""
    doc, ids, places = unpacked(group)
    _, one = np.unique(ids, axis=0, return_inverse=True)  # a document comes once from each bucket
    doc = one.ravel()[doc]
    first = np.zeros((int(one.max(initial=-1)) + 1, 2), np.int64)
    first[one.ravel()] = ids
    order = np.lexsort((places, doc))
    doc, places = doc[order], places[order]
    cut = np.flatnonzero(np.diff(doc, prepend=-1)).tolist()
    ends = [*cut[1:], len(doc)]
    return pd.DataFrame({
        "did": first[doc[cut], 0], "tkey": first[doc[cut], 1], "places": [packed_places(places[a:b]) for a, b in zip(cut, ends)],
    })


def gathered(replies: DataFrame) -> DataFrame:
    """``(did, tkey, places)``, a row per document; places are packed, see :func:`places_of`."""
    return replies.groupBy("home").applyInPandas(_by_document, _FOUND)


def _probes(buckets: int, width: int):
    """Runs of ``ANCHOR`` words and reference blocks of the documents, by bucket; ``width`` low bytes of each hash."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches):
            dids, tkeys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            _, _, words, before = word_hashes(data, offsets)
            at, rows = rolling(before, ANCHOR)
            hashes = Windows(words, 1).of(at, at + ANCHOR)
            whole = (at - before[rows]) % ANCHOR == 0
            block_hash, block_row, block_no = hashes[whole], rows[whole], (at[whole] - before[rows[whole]]) // ANCHOR
            hashes = np.sort(hashes)
            if len(hashes) > 2:
                hashes = np.concatenate([hashes[:2], hashes[2:][hashes[2:] != hashes[:-2]]])  # two of each at most
            low = lambda h: h.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
            cut_off = np.uint64((1 << 8 * width) - 1)
            # Sorted, and the first bytes of all before the second: high bytes then repeat, and pack well.
            planes = lambda h: np.sort(h & cut_off).view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
            order, parts = by_bucket(block_hash, buckets)
            asked = {p: order[a:b] for p, a, b in parts}
            out = []
            for p, a, b in by_bucket(hashes, buckets)[1]:
                own = asked.get(p, order[:0])
                own.sort()
                out.append((p, len(own).to_bytes(4, "little") + low(block_hash[own]) + planes(hashes[a:b]), *packed_rows(block_row[own], block_no[own], dids, tkeys)))
            yield _messages(out)

    return probe


def _messages(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], names=[c.split()[0] for c in _MESSAGE.split(", ")]
    )


def _widened(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view(np.uint64).ravel()


def _from_planes(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, -1).T
    return out.view(np.uint64).ravel()


def _met(width: int, homes: int):
    """Blocks of a bucket whose hash stands in the bucket twice or more."""

    def met(group: pd.DataFrame) -> pd.DataFrame:
        blocks, all_ = [], []
        for payload in group["payload"]:
            cut = 4 + width * int.from_bytes(payload[:4], "little")
            blocks.append(payload[4:cut])
            all_.append(_from_planes(payload[cut:], width))
        doc, ids, places = unpacked(group)
        seen = np.sort(np.concatenate(all_))
        asked = _widened(b"".join(blocks), width)
        many = np.searchsorted(seen, asked, "right") - np.searchsorted(seen, asked, "left") > 1
        return answers(doc[many], ids, places[many], homes)

    return met


def _near_anchors(before: np.ndarray, anchors: list[np.ndarray | None]) -> tuple[np.ndarray, np.ndarray]:
    """Windows of ``WINDOW`` words that hold an anchor of their row."""
    at, rows = rolling(before, WINDOW)
    if not len(at):
        return at, rows
    n = int(before[-1])
    starts = np.zeros(n + 1, np.int64)  # anchors that start at each word
    for row, blocks in enumerate(anchors):
        if blocks is not None:
            starts[before[row] + blocks.astype(np.int64) * ANCHOR] = 1
    sums = np.concatenate([[0], np.cumsum(starts)])
    hold = sums[at + WINDOW - ANCHOR + 1] > sums[at]
    return at[hold], rows[hold]


def _candidate_windows(buckets: int):
    """Candidate windows by bucket: 96 bits, document and place of each."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches):
            dids, tkeys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            anchors = [places_of(x) if x else None for x in batch.column(3).to_pylist()]
            _, _, words, before = word_hashes(data, offsets)
            at, rows = _near_anchors(before, anchors)
            first = Windows(words, 1).of(at, at + WINDOW)
            second = Windows(words, 0).of(at, at + WINDOW).astype(np.uint32)
            order, parts = by_bucket(first, buckets)
            out = []
            for p, a, b in parts:
                own = np.sort(order[a:b])
                out.append((p, first[own].tobytes() + second[own].tobytes(), *packed_rows(rows[own], at[own] - before[rows[own]], dids, tkeys)))
            yield _messages(out)

    return emit


def _repeats(homes: int):
    def repeats(group: pd.DataFrame) -> pd.DataFrame:
        return answers(*later_windows(group), homes)

    return repeats


def later_windows(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of a bucket whose words start earlier somewhere."""
    first = np.concatenate([np.frombuffer(x[: len(x) // 12 * 8], np.uint64) for x in group["payload"]])
    second = np.concatenate([np.frombuffer(x[len(x) // 12 * 8 :], np.uint32) for x in group["payload"]])
    doc, ids, places = unpacked(group)
    did = ids[doc, 0]
    order = np.lexsort((places, did, second, first))
    new = np.ones(len(order), bool)
    f, s = first[order], second[order]
    new[1:] = (f[1:] != f[:-1]) | (s[1:] != s[:-1])
    lead = order[np.flatnonzero(new)][np.cumsum(new) - 1]  # the earliest of each window's words
    later = (did[order] != did[lead]) | (places[order] != places[lead])
    own = order[later]
    return doc[own], ids, places[own]


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and digest of each row without the words that its repeated windows cover."""
    for batch, data, offsets in pieces(batches):
        starts, ends, before = spaced_words(data, offsets)
        raw = data.tobytes()
        removed, digests, spans = [], [], []
        for row, found in enumerate(batch.column(3).to_pylist()):
            a, b = int(before[row]), int(before[row + 1])
            keep = np.ones(b - a, bool)
            if found:
                froms, tos = runs(np.sort(places_of(found).astype(np.int64)), WINDOW)
                for x, y in zip(froms.tolist(), tos.tolist()):
                    keep[x:y] = False
                spans.append(len(froms))
            else:
                spans.append(0)
            at = np.flatnonzero(keep) + a
            words = b" ".join([raw[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist())])
            removed.append(b - a - len(at))
            digests.append(hashlib.sha256(words).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(before)), pa.array(removed, pa.int64()), pa.array(digests), pa.array(spans, pa.int64())],
            names=["did", "n_words", "n_removed", "kept_sha256", "n_spans"],
        )


def repeated_windows(named: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """``(did, tkey, places)``: packed first words of the windows whose words start earlier, for texts that have any.

    Answers go to homes of ``HOME_BYTES`` of text first, so that their rows do not grow with buckets times texts.
    """
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, -(-total // (6 * BUCKET)))  # a word is about six bytes
    # Low bytes of a hash that, with the bucket, tell apart a hundred times as many hashes as there are words: one block in
    # a hundred is an anchor by chance then, which costs less than another byte of every hash.
    width = min(8, max(4, -(-(int(total // 6).bit_length() + 7 - int(buckets).bit_length()) // 8)))
    probes = named.mapInArrow(_probes(buckets, width), _MESSAGE)
    homes = max(8, -(-total // HOME_BYTES))
    anchors = gathered(probes.groupBy("bucket").applyInPandas(_met(width, homes), _REPLY))
    windows = named.join(anchors, ["did", "tkey"]).mapInArrow(_candidate_windows(buckets), _MESSAGE)
    return gathered(windows.groupBy("bucket").applyInPandas(_repeats(homes), _REPLY))


def substring_dedup(docs: DataFrame) -> DataFrame:
    """``(did, n_words, n_removed, kept_sha256, n_spans)`` of every row of ``docs``."""
    named = identified(docs)
    marked = named.join(repeated_windows(named), ["did", "tkey"], "left")
    return marked.mapInArrow(_kept, "did long, n_words long, n_removed long, kept_sha256 string, n_spans long")


def op10(docs: DataFrame) -> DataFrame:
    return substring_dedup(docs).select(given_id(F.col("did")).alias("doc_id"), "n_words", "n_removed", "kept_sha256", "n_spans")


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(list_slice(ws, i, i + 19), ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS n FROM win) WHERE n > 1),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM late) GROUP BY doc_id),
kept AS (SELECT w.doc_id, ws, COALESCE(len(ps), 0) AS n_removed,
  CASE WHEN ps IS NULL THEN ws ELSE list_transform(list_filter(range(1, len(ws) + 1), lambda p: NOT list_contains(ps, p)), lambda p: ws[p]) END AS k
  FROM w LEFT JOIN gone USING (doc_id)),
runs AS (SELECT doc_id, count(*) AS n_spans FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS b FROM late)
  WHERE b IS NULL OR i - b > 20 GROUP BY doc_id)
SELECT kept.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
 sha256(array_to_string(k, ' ')) AS kept_sha256, CAST(COALESCE(n_spans, 0) AS BIGINT) AS n_spans
FROM kept LEFT JOIN runs USING (doc_id)
"""
