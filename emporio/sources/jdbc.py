"""Incremental extraction from the operational database."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporio.registry import TableEntry

# Fixed value: the mark of a table that was never extracted.
EPOCH = datetime(2000, 1, 1, tzinfo=timezone.utc)
ROWS_PER_SLICE = 500_000


@dataclass(frozen=True)
class JdbcConf:
    url: str
    driver: str | None = None
    user: str | None = field(default=None, repr=False)
    password: str | None = field(default=None, repr=False)


def reader_options(
    entry: TableEntry,
    jdbc: JdbcConf,
    watermark: datetime,
    until: datetime,
    fetch_size: int = 50_000,
    partitions: int = 8,
) -> dict[str, str]:
    """Options of a scan cut into ``partitions`` slices of the watermark range."""
    options = {
        "url": jdbc.url,
        "dbtable": entry.full_name,
        "fetchsize": str(fetch_size),
        "driver": jdbc.driver,
        "user": jdbc.user,
        "password": jdbc.password,
    }
    if partitions > 1 and until > watermark:
        options |= {
            "partitionColumn": entry.watermark_col,
            "lowerBound": watermark.isoformat(sep=" "),
            "upperBound": until.isoformat(sep=" "),
            "numPartitions": str(partitions),
        }
    return {k: v for k, v in options.items() if v is not None}


def _stamp(at: datetime | date) -> str:
    text = at.isoformat(sep=" ") if isinstance(at, datetime) else f"{at.isoformat()} 00:00:00"
    return f"TIMESTAMP '{text.removesuffix('+00:00')}'"


def histogram_query(entry: TableEntry, watermark: datetime = EPOCH) -> str:
    """Rows per day of the watermark column, counted by the database; a table never extracted is counted whole."""
    col = entry.watermark_col
    where = "" if watermark == EPOCH else f" WHERE {col} > {_stamp(watermark)}"
    return f"SELECT CAST({col} AS DATE) AS dia, COUNT(*) AS linhas FROM {entry.full_name}{where} GROUP BY CAST({col} AS DATE)"


def slices(
    entry: TableEntry, histogram: Iterable[tuple[date | None, int]], watermark: datetime = EPOCH, rows: int = ROWS_PER_SLICE
) -> list[str]:
    """Predicates that cut the extract into parts of about ``rows`` rows; every row meets exactly one.

    Slices are ranges of days that follow one another, the first without a lower bound but the watermark and the last
    without an upper one, so a row that changes after the count is still read.  A day with more rows is divided by the
    remainder of its key.  Rows without a mark are a slice of their own when a table is extracted whole.
    """
    col, key = entry.watermark_col, entry.natural_key[0]
    days = sorted((d, n) for d, n in histogram if d is not None)
    starts: list[tuple[date | None, int]] = []  # first day of each slice, and its rows
    for day, n in days:
        if not starts or (starts[-1][1] + n > rows and starts[-1][1]):
            starts.append((day, n))
        else:
            starts[-1] = (starts[-1][0], starts[-1][1] + n)
    starts = starts or [(None, 0)]
    out = []
    for i, (day, n) in enumerate(starts):
        bounds = [f"{col} > {_stamp(watermark)}"] if watermark != EPOCH else [f"{col} IS NOT NULL"]
        if i:
            bounds.append(f"{col} >= {_stamp(day)}")
        if i + 1 < len(starts):
            bounds.append(f"{col} < {_stamp(starts[i + 1][0])}")
        parts = -(-n // rows) if n > rows else 1
        remainders = [f"MOD(ABS({key}), {parts}) = {r}" for r in range(parts)] if parts > 1 else [None]
        out += [" AND ".join([*bounds, *([r] if r else [])]) for r in remainders]
    return [*out, f"{col} IS NULL"] if watermark == EPOCH else out


def extract_incremental(
    spark: SparkSession,
    entry: TableEntry,
    jdbc: JdbcConf,
    watermark: datetime = EPOCH,
    fetch_size: int = 50_000,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Rows changed strictly after ``watermark`` (S1), cast to the declared schema; all rows if there is no mark yet.

    The database is asked for a count per day first, at most as many rows as the calendar has days; the extract is then
    cut into slices of equal size, each a query of its own.  Rows go straight from the database to the executors.
    """
    options = reader_options(entry, jdbc, watermark, watermark, fetch_size, partitions=1)
    connection = {k: v for k, v in options.items() if k != "dbtable"}
    counted = spark.read.format("jdbc").options(**connection, query=histogram_query(entry, watermark)).load().collect()
    predicates = slices(entry, [(r[0], r[1]) for r in counted], watermark, rows_per_slice)
    properties = {k: v for k, v in connection.items() if k != "url"}
    changed = spark.read.jdbc(jdbc.url, entry.full_name, predicates=predicates, properties=properties)
    return changed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in entry.source_schema])
