"""Versioned dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporio.functions.keys import row_hash
from emporio.operators.joins import interval_join

OPEN_END = date(9999, 12, 31)


def scd2_columns(df: DataFrame, valid_from, tracked: Sequence[str]) -> DataFrame:
    """Add the version columns of a dimension that holds one current row per key."""
    return df.withColumns(
        {
            "valid_from": valid_from,
            "valid_to": F.lit(OPEN_END),
            "fl_current": F.lit(True),
            "hash_row": row_hash(*tracked),
        }
    )


def scd2_apply(
    current: DataFrame, source: DataFrame, natural_key: str, tracked: Sequence[str], as_of: date
) -> DataFrame:
    """Next state of a versioned dimension.

    ``current`` has all versions; ``source`` one row per key without version
    columns.  Unchanged keys keep their version, changed keys get their version
    closed the day before ``as_of`` and a new one opened, keys gone from the
    source are closed, new keys open at ``as_of``.  A second run on the same
    day replaces the version opened that day instead of closing it backwards.
    """
    history = current.filter(~F.col("fl_current"))
    live = current.filter("fl_current")
    fresh = source.withColumn("hash_row", row_hash(*tracked))
    s = fresh.select(
        F.col(natural_key).alias("__key"),
        F.struct(*fresh.columns).alias("__new"),
    )
    both = live.select(F.col(natural_key).alias("__old_key"), F.struct(*live.columns).alias("__old")).join(
        s, F.col("__old_key") == F.col("__key"), "full_outer"
    )
    changed = F.col("__new.hash_row") != F.col("__old.hash_row")
    is_new, is_gone = F.col("__old").isNull(), F.col("__new").isNull()
    opens = F.when(is_new | changed, F.lit(as_of)).otherwise(F.col("__old.valid_from"))

    def version(side: str, overrides: dict[str, Column]) -> Column:
        available = set(live.columns if side == "__old" else fresh.columns)

        def value(c: str) -> Column:
            if c in overrides:
                return overrides[c]
            return F.col(f"{side}.{c}") if c in available else F.lit(None)

        return F.struct(*[value(f.name).cast(f.dataType).alias(f.name) for f in current.schema])

    opened = F.when(
        ~is_gone, version("__new", {"valid_from": opens, "valid_to": F.lit(OPEN_END), "fl_current": F.lit(True)})
    )
    closed = F.when(
        ~is_new & (is_gone | changed) & (F.col("__old.valid_from") < F.lit(as_of)),
        version("__old", {"valid_to": F.lit(as_of - timedelta(days=1)), "fl_current": F.lit(False)}),
    )
    # One pass over the join: each key yields its open version, its closed one, or both.
    versions = both.select(F.explode(F.array_compact(F.array(opened, closed))).alias("v")).select("v.*")
    return history.select(*current.columns).unionByName(versions)


def scd2_as_of(
    fact: DataFrame, dim: DataFrame, natural_key: str, date_col: str, how: str = "left"
) -> DataFrame:
    """Pair each fact row with the dimension version valid on its date.

    Versions of a key do not overlap and start on different days, so a row
    meets at most one of them.
    """
    return interval_join(fact, dim, date_col, "valid_from", "valid_to", keys=[natural_key], how=how)
