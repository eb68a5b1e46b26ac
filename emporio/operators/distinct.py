"""Exact distinct counts that can be stored and merged (A5).

Whole numbers are kept as bitmaps of 64 ids each, one per group, day and range of ids.  Bitmaps of days are merged by OR,
so the distinct members of a month, of all stores or of any days come from the stored days, not from the rows.  A bitmap is
one whole number: a state has at most a row per member and day, however far apart the ids lie, and a 64th of it where they
are dense.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, BITS = "__faixa", "__bits"


def members(df: DataFrame, keys: Sequence[str], who: str | Column) -> DataFrame:
    """``keys``, range of ids and bitmap: the state to store.  Rows without an id are no members.

    The bitmaps are built before the shuffle, so a hot group sends one per task and range, and in place in the hash table
    of the aggregation, which holds eight bytes of them per group and spills.
    """
    member = (F.col(who) if isinstance(who, str) else who).cast("long")
    placed = df.withColumn("__who", member).filter("__who IS NOT NULL")
    bucket, position = F.shiftright("__who", 6), F.col("__who").bitwiseAND(63).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), position)
    return placed.groupBy(*keys, bucket.alias(BUCKET)).agg(F.bit_or(bit).alias(BITS))


def merged(states: Sequence[DataFrame] | DataFrame, keys: Sequence[str]) -> DataFrame:
    """States of more rows, or by fewer keys: members that meet count once."""
    rows = states if isinstance(states, DataFrame) else reduce(DataFrame.unionByName, states)
    return rows.groupBy(*keys, BUCKET).agg(F.bit_or(BITS).alias(BITS))


def member_count(state: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Members per ``keys``, at most as fine as the state's own."""
    return merged(state, keys).groupBy(*keys).agg(F.sum(F.bit_count(BITS)).alias(out))
