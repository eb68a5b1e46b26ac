"""Joins of the star schema.

No join here hints a broadcast on a table that grows: Spark broadcasts by the
measured size and adaptive execution splits hot join partitions.  Only the
calendar and the channels, whose rows configuration bounds, are hinted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread_nulls(key: Column, by: str | Column) -> Column:
    """``key`` as a long, a NULL replaced by a number far below all ids that differs from row to row.

    A left join on it finds nothing for such rows, as for NULL, but deals them
    over all shuffle partitions.
    """
    return F.when(key.isNull(), -F.pmod(F.xxhash64(by), F.lit(1 << 61)) - F.lit(1 << 62)).otherwise(key.cast("long"))


def left_join_sparse(df: DataFrame, other: DataFrame, key: str, spread_by: str) -> DataFrame:
    """Left join on a ``key`` that is NULL on many rows of ``df``."""
    right = other.withColumn("__other", F.col(key).cast("long")).drop(key)
    return df.join(right, spread_nulls(F.col(key), spread_by) == F.col("__other"), "left").drop("__other")


@dataclass(frozen=True)
class Lookup:
    """One foreign key to resolve: natural key ``on`` of the fact to a surrogate key.

    ``surrogate`` names the dimension's key column, or is a function giving the
    key of a natural key.  With a function the dimension only has to tell which
    natural keys exist: its side of the join shrinks to distinct ids, cannot
    multiply fact rows, and the whole join disappears from plans that do not
    read the surrogate.

    ``bounded`` hints a broadcast for a dimension whose rows configuration bounds.
    ``spread_nulls_by`` names a high-cardinality fact column: rows with a NULL
    key (they match nothing) are dealt by its hash, so that an often-empty key
    does not pile up in one shuffle partition.

    ``natural_alias`` names a column for the natural key that was found, NULL on
    a miss: it tells the same groups as the surrogate in a fraction of its bytes.
    """

    dim: DataFrame
    on: str | Column
    natural_key: str
    surrogate: str | Callable[[Column], Column]
    default: str | int
    alias: str
    bounded: bool = False
    spread_nulls_by: str | None = None
    natural_alias: str | None = None


def star_lookup(fact: DataFrame, *lookups: Lookup) -> DataFrame:
    """Add the surrogate key of each lookup, its default where nothing matches.

    Only current versions are looked up when a dimension is versioned.
    """
    out, keys = fact, []
    for i, look in enumerate(lookups):
        current = look.dim.filter("fl_current") if "fl_current" in look.dim.columns else look.dim
        natural = F.col(f"__nk{i}")
        side = current.select(F.col(look.natural_key).alias(f"__nk{i}"))
        if isinstance(look.surrogate, str):
            side = current.select(F.col(look.natural_key).alias(f"__nk{i}"), F.col(look.surrogate).alias(f"__sk{i}"))
            found = F.col(f"__sk{i}")
        else:
            side = side.distinct()
            found = F.when(natural.isNotNull(), look.surrogate(natural))
        keys.append(F.coalesce(found, F.lit(look.default)).alias(look.alias))
        if look.natural_alias:
            keys.append(natural.alias(look.natural_alias))
        key = F.col(look.on) if isinstance(look.on, str) else look.on
        condition = key == natural
        if look.spread_nulls_by:
            condition = spread_nulls(key, look.spread_nulls_by) == natural.cast("long")
        if look.bounded:
            side = F.broadcast(side)
        out = out.join(side, condition, "left")
    return out.select(*fact.columns, *keys)


def join_aggregate(df: DataFrame, aggregate: DataFrame, keys: Sequence[str], zero_cols: Sequence[str] = ()) -> DataFrame:
    """Left join to a side already aggregated by ``keys``, missing measures as zero."""
    joined = df.join(aggregate, list(keys), "left")
    zero = set(zero_cols)
    return joined.select(
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) if c in zero else F.col(c) for c in joined.columns]
    )


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose non-NULL key has no row in the dimension."""
    known = dim.select(F.col(dim_key or fact_key).alias("__known"))
    return fact.filter(F.col(fact_key).isNotNull()).join(known, F.col(fact_key) == F.col("__known"), "left_anti")


def having_any(df: DataFrame, key: str, *conditions: Column) -> DataFrame:
    """Keys for which every condition holds on some row (J12): one aggregation, no self-join."""
    flags = [F.max(c.cast("int")).alias(f"__any{i}") for i, c in enumerate(conditions)]
    out = df.groupBy(key).agg(*flags)
    for i in range(len(conditions)):
        out = out.filter(F.col(f"__any{i}") == 1)
    return out.select(key)


# Days are numbered from the first of the year 1; 22 levels of halving hold all days to the end of the year 9999.
FIRST_DAY = "0001-01-01"
LEVELS = 22


def _day_number(day: str) -> Column:
    return F.datediff(F.col(day), F.lit(FIRST_DAY).cast("date"))


def _node(level: int, index: Column) -> Column:
    """Number of a block of ``2 ** level`` days."""
    return F.lit(level << (LEVELS + 1)) + index


def tiles(lo: str, hi: str) -> Column:
    """The dyadic blocks of days that together make up ``[lo, hi]``: at most two per level, however long the range."""
    first, end = F.greatest(_day_number(lo), F.lit(0)), F.least(_day_number(hi) + 1, F.lit(1 << LEVELS))
    blocks = []
    for k in range(LEVELS + 1):
        left, right = F.shiftright(first + ((1 << k) - 1), k), F.shiftright(end, k)
        blocks.append(F.when((left < right) & (left % 2 == 1), _node(k, left)))
        blocks.append(F.when((left < right) & (right % 2 == 1), _node(k, right - 1)))
    return F.array_compact(F.array(*blocks))


def blocks_of(day: str) -> Column:
    """The block of each level that holds a day."""
    return F.array(*[_node(k, F.shiftright(_day_number(day), k)) for k in range(LEVELS + 1)])


def interval_join(
    points: DataFrame,
    ranges: DataFrame,
    point: str,
    lo: str,
    hi: str,
    keys: Sequence[str] = (),
    how: str = "inner",
) -> DataFrame:
    """Pair each row with the closed ranges ``[lo, hi]`` its date falls in.

    With ``keys`` the ranges are versions of one entity: an equi-join on the
    keys with the range as a residual condition.  Without keys a range becomes
    the few dyadic blocks it is made of, each day that occurs among the points
    asks for its block of each level, and the rows then meet the ranges of their
    day.  There is no nested-loop join, an open end costs no more than a short
    range, and a day and a range are only paired if a row has that day.  Ranges
    without a start or end, or that end before they start, hold no day.
    """
    if keys:
        right = ranges.select(
            *[F.col(k).alias(f"__{k}") for k in keys], *[c for c in ranges.columns if c not in keys]
        )
        condition = F.col(point).between(F.col(lo), F.col(hi))
        for k in keys:
            condition = condition & (F.col(k) == F.col(f"__{k}"))
        return points.join(right, condition, how).drop(*[f"__{k}" for k in keys])
    days = points.select(F.col(point).alias("__day")).distinct()
    asked = days.withColumn("__block", F.explode(blocks_of("__day")))
    tiled = ranges.filter(F.col(hi) >= F.col(lo)).withColumn("__block", F.explode(tiles(lo, hi)))
    in_force = asked.join(tiled, "__block").drop("__block")
    return points.join(in_force, F.col(point) == F.col("__day"), how).drop("__day")
