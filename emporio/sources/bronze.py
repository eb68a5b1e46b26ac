"""Reading the date-partitioned Bronze layer."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporio.registry import TableEntry

def table_path(entry: TableEntry, root: str) -> str:
    return f"{root.rstrip('/')}/{entry.schema}/{entry.table}"


def partition_path(entry: TableEntry, root: str, day: date) -> str:
    return f"{table_path(entry, root)}/year={day.year}/month={day.month:02d}/day={day.day:02d}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever filesystem it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(hadoop_path)


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(hadoop_path, True)


def on_or_after(day: date) -> Column:
    """Partition filter: directories not older than ``day``."""
    year, month = F.col("year").cast("int"), F.col("month").cast("int")
    dom = F.col("day").cast("int")
    return (year > day.year) | (
        (year == day.year) & ((month > day.month) | ((month == day.month) & (dom >= day.day)))
    )


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A typed frame without rows."""
    return spark.createDataFrame([], schema)


def has_data(spark: SparkSession, entry: TableEntry, root: str) -> bool:
    """Whether any Parquet file of the table exists (decides the ``smart`` mode)."""
    path = table_path(entry, root)
    if not path_exists(spark, path):
        return False
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return not files.load(path).select("path").isEmpty()


def read_bronze(spark: SparkSession, entry: TableEntry, root: str, since: datetime | None = None) -> DataFrame:
    """Rows of a table written with the declared schema.

    ``since`` keeps batches ingested later and prunes the directories of
    earlier days.  A table without files reads as empty.
    """
    path = table_path(entry, root)
    if not path_exists(spark, path):
        return empty(spark, entry.bronze_schema)
    rows = spark.read.schema(_with_partitions(entry.bronze_schema)).parquet(path)
    if since is not None:
        rows = rows.filter(on_or_after(since.date())).filter(F.col("_ingested_at") > F.lit(since))
    return rows.select(*entry.bronze_schema.names)


def _with_partitions(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(c, T.IntegerType()) for c in ("year", "month", "day")]])


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Physical schema text of each listed file, read from its footer inside the task."""
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    for batch in batches:
        signatures = []
        for uri in batch["path"]:
            filesystem, path = pafs.FileSystem.from_uri(uri)
            schema = pq.read_schema(path, filesystem=filesystem)
            signatures.append(";".join(sorted(f"{f.name}:{f.type}" for f in schema)))
        yield pd.DataFrame({"path": batch["path"], "signature": signatures})


def _tolerant_cast(column: str, source: T.DataType, target: T.DataType) -> Column:
    """Cast one drifted column; an id that became a double is rounded half to even first."""
    value = F.col(column)
    if isinstance(source, (T.DoubleType, T.FloatType)) and isinstance(target, T.IntegralType):
        value = F.bround(value)
    if isinstance(source, T.NullType):
        value = F.lit(None)
    return value.cast(target).alias(column)


def read_bronze_tolerant(spark: SparkSession, entry: TableEntry, root: str) -> DataFrame:
    """Rows of a table whose files differ in physical types or columns.

    Spark refuses such a directory as a whole, so files are grouped by their
    footer schema, each group is read and cast, and the groups are united.  The
    footers are read in parallel tasks; the driver sees file names, as it does
    for any scan.
    """
    path = table_path(entry, root)
    if not path_exists(spark, path):
        return empty(spark, entry.bronze_schema)
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path")
    )
    groups = (
        files.mapInPandas(_footers, "path string, signature string")
        .groupBy("signature")
        .agg(F.collect_list("path").alias("paths"))
        .collect()
    )
    out = empty(spark, entry.bronze_schema)
    for group in groups:
        part = spark.read.parquet(*group["paths"])
        types = {f.name: f.dataType for f in part.schema}
        columns = [
            _tolerant_cast(f.name, types[f.name], f.dataType)
            if f.name in types
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in entry.bronze_schema
        ]
        out = out.unionByName(part.select(*columns))
    return out


def batch_rows(spark: SparkSession, entry: TableEntry, root: str, day: date) -> int | None:
    """Rows landed on ``day`` (S9); ``None`` when the partition does not exist.

    A count without columns is answered from the Parquet footers.
    """
    path = partition_path(entry, root, day)
    if not path_exists(spark, path):
        return None
    return spark.read.schema(entry.bronze_schema).parquet(path).count()


def newest_file(spark: SparkSession, entry: TableEntry, root: str) -> datetime | None:
    """Modification time of the newest file (S10), from file metadata only."""
    path = table_path(entry, root)
    if not path_exists(spark, path):
        return None
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
    )
    return files.agg(F.max("modificationTime")).first()[0]


def missing_tables(spark: SparkSession, entries, root: str) -> list[str]:
    """Tables without any file (Q10)."""
    return [e.full_name for e in entries if not has_data(spark, e, root)]

