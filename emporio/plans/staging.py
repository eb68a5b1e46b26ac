"""Staging: newest version per key, typed and cleaned.

One builder serves all tables; what differs between them is in the registry.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporio.operators.dedup import latest_per_key
from emporio.operators.incremental import high_water
from emporio.registry import Column, TableEntry
from emporio.sinks.tables import Warehouse
from emporio.sources.bronze import read_bronze

_CLEAN = {
    "trim": F.trim,
    "lower": lambda c: F.trim(F.lower(c)),
    "upper": lambda c: F.upper(F.trim(c)),
}


def typed(column: Column, source: T.DataType | None = None) -> SparkColumn:
    """Cast and clean one column; a double becoming an integer rounds half to even."""
    value = F.col(column.name)
    if isinstance(source, (T.DoubleType, T.FloatType)) and isinstance(column.dtype, T.IntegralType):
        value = F.bround(value)
    value = value.cast(column.dtype)
    return (_CLEAN[column.clean](value) if column.clean else value).alias(column.name)


def project(df: DataFrame, entry: TableEntry) -> DataFrame:
    """The declared output columns of the table."""
    types = {f.name: f.dataType for f in df.schema}
    return df.select(
        *[typed(c, types.get(c.name)) for c in entry.columns], F.col("_ingested_at").cast("timestamp").alias("_ingested_at")
    )


def build_staging(source: DataFrame, entry: TableEntry, order_by: Sequence[str] = ("updated_at", "_ingested_at")) -> DataFrame:
    """Newest version of each key (W1, W2), typed.

    Ties on the ordering columns are broken by all remaining columns.
    """
    return project(latest_per_key(source, entry.natural_key, order_by), entry)


# Serial ids per partition of a staging table: new rows fall into the last few.
IDS_PER_PARTITION = 5_000_000


def id_partition(entry: TableEntry) -> SparkColumn:
    """Partition of a row by its leading key, so a key never changes partition."""
    return F.floor(F.col(entry.natural_key[0]) / IDS_PER_PARTITION).cast("int")


def refresh_staging(
    spark: SparkSession, entry: TableEntry, bronze_root: str, warehouse: Warehouse, full_refresh: bool = False
) -> DataFrame:
    """Bring one staging table up to date from the batches it has not seen (S3, K5).

    The winner of a key is the newest version over table and batch, so a
    re-extracted older row does not replace a newer one.
    """
    mark = None if full_refresh else warehouse.marks(entry.staging_name).get("bronze")
    batch = read_bronze(spark, entry, bronze_root, since=mark)
    newest = high_water(batch.select(F.unix_micros("_ingested_at").alias("at")), "at")
    if newest is None and warehouse.exists(entry.staging_name) and not full_refresh:
        return warehouse.read(entry.staging_name)
    seen = None if newest is None else datetime.fromtimestamp(newest / 1_000_000, tz=timezone.utc)
    return warehouse.upsert(
        build_staging(batch, entry),
        entry.staging_name,
        entry.natural_key,
        partition=id_partition(entry),
        order_by=("updated_at", "_ingested_at"),
        full_refresh=full_refresh,
        marks=None if seen is None else {"bronze": seen},
    )
