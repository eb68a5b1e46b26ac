"""Control log: extraction watermarks and committed table snapshots.

Both are append-only Parquet logs whose newest row per table is the current
state.  A row appears only when its append job commits, so a failed run leaves
the previous state in force, and two jobs never rewrite one another's files.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from emporio.registry import TableEntry
from emporio.sources.bronze import empty, has_data, path_exists
from emporio.sources.jdbc import EPOCH
from pyspark.sql import types as T

WATERMARK_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("last_updated_at", T.TimestampType()),
        T.StructField("updated_at_utc", T.TimestampType()),
        T.StructField("last_checked_at", T.TimestampType()),
    ]
)


def _utc(value: datetime) -> datetime:
    """Naive timestamps count as UTC."""
    return value if value.tzinfo else value.replace(tzinfo=timezone.utc)


class WatermarkLog:
    """Per-table high-water marks of the extraction (K2, K3, K4)."""

    def __init__(self, spark: SparkSession, bronze_root: str):
        self.spark = spark
        self.path = f"{bronze_root.rstrip('/')}/_watermarks"

    def rows(self) -> DataFrame:
        """All log rows, oldest and newest."""
        if not path_exists(self.spark, self.path):
            return empty(self.spark, WATERMARK_SCHEMA)
        return self.spark.read.schema(WATERMARK_SCHEMA).parquet(self.path)

    def current(self) -> DataFrame:
        """One row per table: the state after the newest check."""
        state = F.struct("last_checked_at", "last_updated_at", "updated_at_utc")
        newest = self.rows().groupBy("table").agg(F.max_by(state, state).alias("s"))
        return newest.select("table", "s.last_updated_at", "s.updated_at_utc", "s.last_checked_at")

    def state(self, entry: TableEntry) -> Row | None:
        return self.current().filter(F.col("table") == entry.full_name).first()

    def read(self, entry: TableEntry) -> datetime:
        """The stored mark, or the epoch for a table never extracted."""
        found = self.spark.createDataFrame([(entry.full_name,)], "table string").join(self.current(), "table").select(
            F.unix_micros("last_updated_at").alias("micros")
        ).first()
        if found is None or found["micros"] is None:
            return EPOCH
        return datetime.fromtimestamp(found["micros"] / 1_000_000, tz=timezone.utc)

    def _append(self, row: tuple) -> None:
        self.spark.createDataFrame([row], WATERMARK_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def commit(self, entry: TableEntry, value: datetime, at: datetime | None = None) -> None:
        """Record the mark of a batch; call only after its data is written."""
        now = _utc(at or datetime.now(timezone.utc))
        self._append((entry.full_name, _utc(value), now, now))

    def touch(self, entry: TableEntry, at: datetime | None = None) -> None:
        """Record that the table was checked without news; the mark stays."""
        now = _utc(at or datetime.now(timezone.utc))
        mark = self.read(entry)
        before = self.state(entry)
        kept = (None, None) if before is None or mark == EPOCH else (mark, _utc(before["updated_at_utc"]))
        self._append((entry.full_name, *kept, now))


def resolve_mode(spark: SparkSession, entry: TableEntry, requested: str, bronze_root: str) -> str:
    """``smart`` means full for a table without files, else incremental."""
    if requested not in ("full", "incremental", "smart"):
        raise ValueError(f"unknown mode {requested!r}")
    if requested != "smart":
        return requested
    return "incremental" if has_data(spark, entry, bronze_root) else "full"
