"""Keep one row per key.

All of these rank inside the key and keep rank 1, the shape Spark turns into a
``WindowGroupLimit``: each input partition drops its losers before the shuffle,
so a key holding a large share of the rows sends at most one row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

_RANK = "__rank"


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[Column]) -> DataFrame:
    """The row that sorts first in each key."""
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = ("updated_at",),
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """The newest row of each key.

    ``tiebreak`` defaults to every other column, so equal timestamps still give
    one answer whatever the partitioning.
    """
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in keys and c not in order_by]
    return first_per_key(df, keys, [F.desc_nulls_last(c) for c in [*order_by, *tiebreak]])
