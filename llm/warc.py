"""WARC archives written and read by Spark, with the chain of record boundaries verified.

Writing: each row is one record; Spark's text writer, with the two line ends that close a record as its separator, lays
records one after another in files on any file system Spark knows.  Equal payloads are written once, as a response;
the others are ``revisit`` records that refer to it.

Reading: the archive is cut at every ``WARC/1.1`` line, also those inside payloads.  Each task parses each piece as if a
record began there, and emits the candidate with its offset and the offset of its successor, which the declared length
gives.  Pointer jumping from the start of each file then keeps the candidates that can be reached; the others are
payload bytes that look like records.  Files are read unsplit, also those that Spark could split.  Links inside a block of ``BLOCK`` bytes of a file are followed by one task; the
jumps between blocks double their reach with each round.

Defined cases: a NULL html is an empty payload; equal payloads include empty ones; rows with the largest id of equal
payloads are all responses; bytes after a broken length are not reached and are left out; an empty table writes no
record and reads back as no rows; a file that begins with anything but a ``WARC/1.1`` record is an error.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from base64 import b32encode
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import shared_folder, stored

MAGIC = "WARC/1.1\r\n"
CLOSE = "\r\n\r\n"
BLOCK = 4 << 20
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

_CANDIDATE = (
    "file string, block long, offset long, next long, page_id long, record_type string, payload_bytes long, "
    "payload_digest string, refers_to long, url string, payload string"
)


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 SHA-1: five hex digits are four base32 digits."""
    digest = F.sha1(payload.cast("binary"))
    groups = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), DIGITS, BASE32)


def records(pages: DataFrame) -> DataFrame:
    """``(page_id, url, html, digest, refers_to)``: ``refers_to`` is NULL for responses."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", base32_sha1(F.col("html")))
    keys = rows.select("digest", "page_id")
    kept = keys.groupBy("digest").agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).where("n > 1").drop("n")
    # Only rows that share a payload are looked up; the payload itself moves once, by id.
    revisits = keys.join(kept, "digest").where("page_id < kept").select("page_id", "digest", F.col("kept").alias("refers_to")).distinct()
    return rows.join(revisits, ["page_id", "digest"], "left")


def write_warc(pages: DataFrame, folder: str, compression: str = "gzip") -> None:
    """A record per row of ``pages (page_id, url, html)`` in ``folder``."""
    row = records(pages)
    revisit = F.col("refers_to").isNotNull()
    body = F.when(revisit, F.lit("")).otherwise(F.col("html"))

    def urn(column: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), column.cast("string"), F.lit(">"))

    uri = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\r\n]", "")
    line = F.concat(
        F.lit(f"{MAGIC}WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), urn(F.coalesce(F.col("page_id").cast("string"), F.lit(""))),
        F.lit("\r\nWARC-Target-URI: "), uri,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: "), urn(F.col("refers_to")))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"), body,
    )
    row.select(line.alias("value")).write.option("lineSep", CLOSE).option("compression", compression).text(folder)


_FIELD = re.compile(rb"^([A-Za-z-]+): ?([^\r\n]*)\r$", re.M)


class _Candidate:
    """A record as its header claims it; takes the bytes of its payload from the pieces that follow."""

    def __init__(self, offset: int, head: bytes, size: int, keep: bool):
        self.offset, self.next, self.left = offset, 0, size
        self.fields = dict(_FIELD.findall(head + b"\r\n"))
        self.size, self.sha, self.kept = size, hashlib.sha1(), [] if keep else None

    def take(self, data: bytes) -> None:
        data = data[: self.left]
        self.left -= len(data)
        self.sha.update(data)
        if self.kept is not None:
            self.kept.append(data)

    def row(self, file: str) -> tuple:
        field = lambda name: self.fields.get(name, b"").decode("utf-8", "replace")
        number = lambda name: int(m[1]) if (m := re.search(r":(-?\d+)>$", field(name))) else None
        kind = field(b"WARC-Type")
        own = b32encode(self.sha.digest()).decode()
        digest = own if kind != "revisit" else field(b"WARC-Payload-Digest").removeprefix("sha1:")
        payload = b"".join(self.kept).decode("utf-8", "replace") if self.kept is not None else None
        return (
            file, self.offset // BLOCK, self.offset, self.next, number(b"WARC-Record-ID"), kind, self.size, digest,
            number(b"WARC-Refers-To"), field(b"WARC-Target-URI"), payload,
        )


def _parse(keep_payload: bool):
    """Pieces of files, in order, to candidate records.  A partition holds whole files, one after another."""
    magic = MAGIC.encode()

    def head_of(piece: bytes) -> tuple[bytes, int, int] | None:
        end = piece.find(b"\r\n\r\n")
        length = re.search(rb"^Content-Length: (\d{1,15})\r?$", piece[: end + 2], re.M) if end >= 0 else None
        return (piece[:end], end + 4, int(length[1])) if length else None

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, at, waiting, rows, held = None, 0, [], [], 0
        names = [c.split()[0] for c in _CANDIDATE.split(", ")]
        kinds = [pa.string() if c.endswith("string") else pa.int64() for c in _CANDIDATE.split(", ")]

        def out() -> pa.RecordBatch:
            nonlocal rows, held
            columns = list(zip(*rows)) if rows else [()] * len(names)
            rows, held = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            for value, name in zip(batch.column(0), batch.column(1)):
                piece = value.as_buffer().to_pybytes() if value.is_valid else b""
                if name.as_py() != file:
                    file, at, waiting = name.as_py(), len(piece), []
                    if piece:  # what comes before the first record
                        raise ValueError(f"{file} does not begin with {MAGIC.strip()}: {piece[:40]!r}")
                    continue
                whole = magic + piece if waiting else b""
                for c in waiting:
                    c.take(whole)
                start = at
                at += len(magic) + len(piece)
                if (found := head_of(piece)) is not None:
                    head, body, size = found
                    record = _Candidate(start, head, size, keep_payload)
                    record.next = start + len(magic) + body + size + len(CLOSE)
                    record.take(piece[body:])
                    waiting.append(record)
                for c in waiting:
                    if not c.left:
                        rows.append(c.row(file))
                        held += c.size if keep_payload else 200
                waiting = [c for c in waiting if c.left]
                if held > 1 << 20:
                    yield out()
        yield out()

    return parse


def _exits(group: pd.DataFrame) -> pd.DataFrame:
    """For each candidate of a block, the first offset beyond the block on its chain."""
    group = group.sort_values("offset", ignore_index=True)
    ends: dict[int, int] = {}
    for offset, following in zip(group["offset"].tolist()[::-1], group["next"].tolist()[::-1]):
        ends[offset] = ends.get(following, following)  # a record ends after it begins, so its successor is done
    group["out"] = group["offset"].map(ends)
    return group


def _kept(group: pd.DataFrame) -> pd.DataFrame:
    """The candidates of a block on the chain from its entry."""
    entry = group.loc[group["entry"], "offset"]
    following = dict(zip(group["offset"].tolist(), group["next"].tolist()))
    at, met = (int(entry.iloc[0]) if len(entry) else -1), []
    while at in following:
        met.append(at)
        at = following[at]
    return pd.DataFrame({"file": group["file"].iloc[0], "offset": met}).astype({"offset": "int64"})


def reachable(links: DataFrame) -> DataFrame:
    """``(file, offset)`` of the candidates that the chain from offset 0 of their file meets.

    ``links (file, block, offset, next)``.  Each block of a file is first contracted to jumps past its end.  Pointer
    jumping between blocks, each round of twice the reach, finds where the chain enters each block; the links inside
    a block then give the rest.
    """
    by_block = links.groupBy("file", "block")
    links = stored(by_block.applyInPandas(_exits, "file string, block long, offset long, next long, out long"), "links")
    jump = links.select("file", "offset", F.col("out").alias("next"))
    entries, seen = links.where("offset = 0").select("file", "offset"), -1
    while True:
        ahead = jump.join(entries, ["file", "offset"]).select("file", F.col("next").alias("offset"))
        met = ahead.join(links.select("file", "offset"), ["file", "offset"], "left_semi")
        entries = stored(entries.unionByName(met).distinct(), "entries")
        count = entries.count()
        if count == seen:
            break
        seen = count
        far = jump.select("file", F.col("offset").alias("next"), F.col("next").alias("far"))
        jump = stored(jump.join(far, ["file", "next"]).select("file", "offset", F.col("far").alias("next")), "jump")
    marked = links.join(entries.withColumn("entry", F.lit(True)), ["file", "offset"], "left")
    marked = marked.select("file", "block", "offset", "next", F.coalesce("entry", F.lit(False)).alias("entry"))
    return marked.groupBy("file", "block").applyInPandas(_kept, "file string, offset long")


@contextmanager
def _unsplit(spark: SparkSession):
    """Each file is one partition: a split holds as much as any file, and opening a file counts as a whole split."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    minimum = spark.conf.get("spark.sql.files.minPartitionNum", None)
    try:
        for n in names:
            spark.conf.set(n, str(1 << 40))
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        yield
    finally:
        for n, value in zip(names, before):
            spark.conf.set(n, value)
        spark.conf.unset("spark.sql.files.minPartitionNum") if minimum is None else spark.conf.set("spark.sql.files.minPartitionNum", minimum)


def read_warc(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """Verified records of the archives in ``folder``; ``payload`` is filled if ``payloads``."""
    pieces = spark.read.option("lineSep", MAGIC).text(folder).select("value", F.col("_metadata.file_path").alias("file"))
    with nullcontext() if all(f.endswith(".gz") for f in pieces.inputFiles()) else _unsplit(spark):
        found = stored(pieces.mapInArrow(_parse(payloads), _CANDIDATE), "candidates")
    return found.join(reachable(found.select("file", "block", "offset", "next")), ["file", "offset"])


def op2(pages: DataFrame) -> DataFrame:
    """Archives of all pages, read back; a revisit has the size of the response that it refers to."""
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(pages, folder)
    back = stored(read_warc(spark, folder).drop("payload", "url", "block", "file"), "records")
    own = back.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("full")).distinct()
    sized = back.join(own, "refers_to", "left")
    return sized.select(
        "page_id", F.coalesce("full", "payload_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )


ORACLE = f"""
WITH p AS (SELECT page_id, COALESCE(html, '') AS html, sha1(COALESCE(html, '')) AS hex FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes,
 list_aggregate(list_transform(range(32), lambda i: substr('{BASE32}', 1 + CAST((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT)
   >> (5 * (3 - i % 4))) & 31 AS BIGINT), 1)), 'string_agg', '') AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS kept FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
 CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
 CASE WHEN page_id = kept THEN NULL ELSE kept END AS refers_to
FROM m
"""
