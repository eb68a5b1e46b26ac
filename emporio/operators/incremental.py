"""Which rows a run has to look at."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def high_water(target: DataFrame | None, column: str = "_ingested_at") -> datetime | date | None:
    """Largest value of ``column`` in the target; ``None`` when there is no target or it is empty.

    One partial/final aggregate; the single value comes back so that it can be
    a literal, which partition pruning and pushdown need.
    """
    if target is None:
        return None
    return target.agg(F.max(column)).first()[0]


def newer_than(df: DataFrame, column: str, mark: datetime | date | None) -> DataFrame:
    """Rows above the mark, all rows when there is none (S3)."""
    return df if mark is None else df.filter(F.col(column) > F.lit(mark))


def last_days(df: DataFrame, date_col: str, max_date: date | None, days: int = 3) -> DataFrame:
    """Rows from ``days`` before the newest known date onwards."""
    return df if max_date is None else df.filter(F.col(date_col) >= F.lit(max_date - timedelta(days=days)))


def between(df: DataFrame, date_col: str, start: date, end: date) -> DataFrame:
    """Half-open range ``start <= d < end``."""
    return df.filter((F.col(date_col) >= F.lit(start)) & (F.col(date_col) < F.lit(end)))
