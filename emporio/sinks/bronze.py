"""Landing extracted batches."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporio.operators.upsert import align
from emporio.registry import TableEntry
from emporio.sources.bronze import table_path


def with_metadata(df: DataFrame, entry: TableEntry, ingested_at: datetime, rows: int) -> DataFrame:
    """Declared columns plus source, ingestion time and batch size."""
    return align(df, entry.source_schema).select(
        "*",
        F.lit(entry.schema).alias("_source_schema"),
        F.lit(entry.table).alias("_source_table"),
        F.lit(ingested_at).cast("timestamp").alias("_ingested_at"),
        F.lit(rows).cast("long").alias("_row_count_batch"),
    )


def append_bronze(df: DataFrame, entry: TableEntry, root: str, ingested_at: datetime, rows: int) -> str:
    """Append a batch under the directory of its ingestion day (K1).

    Files become visible when the job commits, and their names never collide,
    so two batches in one second keep both.
    """
    path = table_path(entry, root)
    day = {"year": f"{ingested_at.year}", "month": f"{ingested_at.month:02d}", "day": f"{ingested_at.day:02d}"}
    out = with_metadata(df, entry, ingested_at, rows)
    out = out.withColumns({k: F.lit(v) for k, v in day.items()})
    (
        out.write.mode("append")
        .option("compression", "snappy")
        .partitionBy("year", "month", "day")
        .parquet(path)
    )
    return path
