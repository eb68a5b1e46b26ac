"""Orderings over a whole table without putting the table into one task.

A window without ``partitionBy`` sorts everything in a single task.  Instead the
table is range partitioned once by its order, every part is summed on its own,
and the last row of a part tells the other parts what it came to.  A part adds
what the parts before it told: a prefix scan over parts, inside one plan that
reads its input once and starts no job of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporio.functions.numeric import safe_divide

# Every part tells every other one, so messages grow with the square of the parts: a million at this many.
MOST_PARTS = 1000


def _parts(df: DataFrame, parts: int | None) -> int:
    return parts or min(MOST_PARTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _ranged(df: DataFrame, ordering: Sequence[Column], parts: int) -> DataFrame:
    return df.repartitionByRange(parts, *ordering).withColumn("__part", F.spark_partition_id())


def _told(summed: DataFrame, columns: Sequence[str], last: Column, message: Column, parts: int) -> DataFrame:
    """The rows, and the ``__told`` of each part's last row once more for every part: ``__at`` is where a row is needed.

    Rows have their ``columns`` in ``__row`` and no ``__told``; messages the other way round.
    """
    to = F.when(last, F.sequence(F.lit(-1), F.lit(parts - 1))).otherwise(F.array(F.lit(-1)))
    own = F.col("__to") == -1
    return summed.withColumn("__to", F.explode(to)).select(
        F.when(own, F.struct(*columns)).alias("__row"),
        F.when(~own, message).alias("__told"),
        "__part",
        F.when(own, F.col("__part")).otherwise(F.col("__to")).alias("__at"),
    )


def _scanned(df: DataFrame, order: str, tiebreak: str, totals: dict[str, Column], parts: int | None) -> DataFrame:
    """``__row``, and for each name its running sum and the sum over everything as ``__all_<name>``."""
    parts = _parts(df, parts)
    ordering = [F.desc_nulls_last(order), F.asc(tiebreak)]
    line = Window.partitionBy("__part").orderBy(*ordering)
    so_far = line.rowsBetween(Window.unboundedPreceding, 0)
    inside = [F.sum(e).over(so_far).alias(f"__in_{n}") for n, e in totals.items()]
    summed = _ranged(df, ordering, parts).select("*", *inside, F.lead("__part").over(line).isNull().alias("__last"))
    sums = [f"__in_{n}" for n in totals]
    told = _told(summed, [*df.columns, *sums], F.col("__last"), F.struct(*sums), parts)
    here = Window.partitionBy("__at")
    earlier = F.col("__part") < F.col("__at")
    gathered = [F.sum(F.when(earlier, F.col(f"__told.__in_{n}"))).over(here).alias(f"__before_{n}") for n in totals]
    everything = [F.sum(F.col(f"__told.__in_{n}")).over(here).alias(f"__all_{n}") for n in totals]
    rows = told.select("__row", *gathered, *everything).filter("__row IS NOT NULL")

    def running(n: str) -> Column:
        own, before = F.col(f"__row.__in_{n}"), F.col(f"__before_{n}")
        return F.coalesce(own + before, own, before).alias(n)

    return rows.select("__row", *[running(n) for n in totals], *[f"__all_{n}" for n in totals])


def running_totals(df: DataFrame, order: str, tiebreak: str, totals: dict[str, Column], parts: int | None = None) -> DataFrame:
    """Inclusive running sums by ``order`` descending with NULL last, then ``tiebreak`` ascending.

    ``tiebreak`` is unique, so a value that many rows share is spread over parts; ``totals`` maps output names to the
    summed expressions.  Sums of decimals and integers are exact; sums of doubles may differ from a sequential sum in
    the last digits, as additions are grouped by part.
    """
    rows = _scanned(df, order, tiebreak, totals, parts)
    return rows.select(*[F.col(f"__row.{c}").alias(c) for c in df.columns], *totals)


def cumulative_share(df: DataFrame, value: str, tiebreak: str, out: str = "cum_share", parts: int | None = None) -> DataFrame:
    """Share of the total reached when adding rows from the largest ``value`` down (W9); rows without a value come last."""
    rows = _scanned(df, value, tiebreak, {"__running": F.col(value)}, parts)
    share = safe_divide(F.col("__running"), F.col("__all___running"))
    return rows.select(*[F.col(f"__row.{c}").alias(c) for c in df.columns], share.alias(out))


def dense_rank_by(df: DataFrame, value: str, out: str = "rank", parts: int | None = None) -> DataFrame:
    """Dense rank from the largest ``value`` down (W5); rows without a value rank last.

    Rows of one value may lie in several parts, so that a common value is no task of its own.  A part tells how many
    values it has and its first and last one: a value that goes on in the next part is counted there no second time.
    """
    parts = _parts(df, parts)
    ordering = [F.desc_nulls_last(value), F.xxhash64(*df.columns)]
    line = Window.partitionBy("__part").orderBy(F.desc_nulls_last(value))
    # Among equal values any row may be the last: their rank and value are the same.
    nth = F.row_number().over(line)
    summed = _ranged(df, ordering, parts).select(
        "*", F.dense_rank().over(line).alias("__in"), F.first(value).over(line).alias("__first"), nth.alias("__nth"),
        F.count(F.lit(1)).over(Window.partitionBy("__part")).alias("__rows"),
    )
    message = F.struct(F.col("__in").alias("n"), F.col("__first").alias("first"), F.col(value).alias("last"))
    told = _told(summed, [*df.columns, "__in"], F.col("__nth") == F.col("__rows"), message, parts)
    # Messages come before rows, in the order of the parts they are from.
    queue = Window.partitionBy("__at").orderBy(F.col("__row").isNotNull(), "__part")
    previous = F.lag("__told").over(queue)
    goes_on = previous.isNotNull() & previous["last"].eqNullSafe(F.col("__told.first"))
    earlier, until = F.col("__part") < F.col("__at"), F.col("__part") <= F.col("__at")
    marked = told.withColumn("__goes_on", F.when(F.col("__told").isNotNull() & goes_on, 1).otherwise(0))
    here = Window.partitionBy("__at")
    before = F.coalesce(F.sum(F.when(earlier, F.col("__told.n"))).over(here), F.lit(0))
    twice = F.sum(F.when(until, F.col("__goes_on"))).over(here)
    rows = marked.select("__row", (before - twice).alias("__before")).filter("__row IS NOT NULL")
    rank = (F.col("__row.__in") + F.col("__before")).cast("int")
    return rows.select(*[F.col(f"__row.{c}").alias(c) for c in df.columns], rank.alias(out))


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of a total order (L3): a heap per task and one merge, no full sort."""
    return df.orderBy(*order).limit(n)


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(window)).filter(F.col("__n") <= n).drop("__n")


def share_of_total(df: DataFrame, value: str, out: str, within: Sequence[str] = ()) -> DataFrame:
    """Row value over the total of its ``within`` group, or of everything.

    ``df`` is already aggregated.  The totals are a second, smaller aggregate:
    no window collects a group.
    """
    if not within:
        total = df.agg(F.sum(value).alias("__total"))
        return df.withColumn(out, safe_divide(F.col(value), total.scalar()))
    totals = df.groupBy(*within).agg(F.sum(value).alias("__total"))
    joined = df.join(totals, list(within))
    return joined.select(*df.columns, safe_divide(F.col(value), F.col("__total")).alias(out))
