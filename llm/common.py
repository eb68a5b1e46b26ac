"""Helpers the operators share: stored intermediates, and word work on Arrow text without a loop over rows.

Text is taken as UTF-8 bytes.  A batch of rows is cut into pieces of bounded size, and each piece is one byte array
with the offsets of its rows, so that words, hashes and windows of all its rows come from a few array operations.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LAST_ID = (1 << 63) - 1  # stands for a NULL document id, which sorts last
PIECE_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ASCII_WORD = np.ones(256, bool)  # a-z, 0-9 and everything beyond ASCII, once lower-cased
_ASCII_WORD[:0x30] = _ASCII_WORD[0x3A:0x61] = _ASCII_WORD[0x7B:0x80] = False


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; on a local master without it, a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def stored(df: DataFrame, name: str, release: bool = False, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends, and a lost executor costs nothing.

    ``release`` lets Spark delete the shuffle files behind ``df`` now: it does so when the driver's collectors find that
    no plan needs them, which may otherwise take long after large shuffles.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    if release:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete stored frames that no plan reads any more."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        conf = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        path.getFileSystem(conf).delete(path, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def row_key(text: Column) -> Column:
    """With the id, tells rows apart that share an id; rows equal in both are one document written twice."""
    return F.xxhash64(text)


def identified(docs: DataFrame) -> DataFrame:
    """``(did, tkey, text)`` of documents: NULL ids sort last, NULL texts are empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("did"), row_key(text).alias("tkey"), text.alias("text"))


def packed(docs: DataFrame) -> DataFrame:
    """``(doc, did, tkey)``: whole rows beside their names, so that no column of theirs clashes with a name used here."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    did = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), did.alias("did"), row_key(text).alias("tkey"))


def given_id(did: Column) -> Column:
    return F.when(did != LAST_ID, did)


def pieces(batches: Iterable[pa.RecordBatch], limit: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with at most ``limit`` bytes in ``text`` (or one row), its bytes and row offsets."""
    for batch in batches:
        at = 0
        texts = pc.fill_null(batch.column(batch.schema.get_field_index("text")).cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        while at < len(batch):
            done = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
            part = texts.slice(at, to - at)
            buffers = part.buffers()
            offsets = np.frombuffer(buffers[1], np.int64, len(part) + 1, part.offset * 8)
            data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]] if buffers[2] and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
            yield batch.slice(at, to - at), data, offsets - offsets[0]
            at = to


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of a base modulo 2**64 and of its inverse; kept for pieces of usual size, made anew for longer texts."""
    usual = PIECE_BYTES * 5 // 4
    if n < usual and base in _powers:
        return _powers[base]
    size = max(n + 1, usual)
    factor = np.full(size, _BASES[base], np.uint64)
    factor[0] = 1
    inverse = np.full(size, pow(int(_BASES[base]), -1, 1 << 64), np.uint64)
    inverse[0] = 1
    both = np.multiply.accumulate(factor), np.multiply.accumulate(inverse)
    if n < usual:
        _powers[base] = both
    return both


class Windows:
    """Hash of any run of ``values`` (64-bit symbols) from prefix sums of a polynomial."""

    def __init__(self, values: np.ndarray, base: int = 0):
        power, self.inverse = _power(len(values), base)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * power[: len(values)], dtype=np.uint64)])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])


def byte_windows(data: np.ndarray, base: int = 0) -> Windows:
    return Windows(_BYTES[data], base)


def word_bounds(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the number of words before each row (one more entry than rows)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = is_word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    first[cuts] = inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def spaced_words(data: np.ndarray, offsets: np.ndarray):
    """Words ``[^\\x20\\x09-\\x0D]+`` of each row."""
    return word_bounds(data, offsets, ~_SPACE)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def plain_words(low: np.ndarray, offsets: np.ndarray):
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of each row of lower-cased bytes."""
    return word_bounds(low, offsets, _ASCII_WORD)


def rows_of(counts_before: np.ndarray) -> np.ndarray:
    """For each element, its row, from the running counts of elements per row."""
    return np.repeat(np.arange(len(counts_before) - 1), np.diff(counts_before))


def runs(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by windows of ``length`` at sorted ``starts``: first elements and ends."""
    if not len(starts):
        return starts, starts
    cut = np.flatnonzero(np.diff(starts) > length) + 1
    return starts[np.concatenate([[0], cut])], starts[np.concatenate([cut - 1, [len(starts) - 1]])] + length


@lru_cache(1)
def empty_sha256() -> str:
    import hashlib

    return hashlib.sha256(b"").hexdigest()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
