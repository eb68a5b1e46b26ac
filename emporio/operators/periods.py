"""Time-relative operators over values already aggregated per day or month."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporio.functions.calendar import month_start


def period_shifts(
    df: DataFrame,
    date_col: str,
    value: str,
    shifts: dict[str, tuple[int, int]],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Value of the same group in earlier periods; ``shifts`` maps output names to (months, days) back.

    By date rather than with ``lag``, because periods may be missing; an absent
    period gives NULL.  ``df`` has one row per group and date.  Each row is sent
    once as itself and once per shift to the dates that look back at it (several
    after a month's last day, where shorter months clamp), and one grouping
    brings them together: the input is computed once.
    """
    names, others = list(shifts), [c for c in df.columns if c not in (date_col, *keys)]
    here, no_dates = F.col(date_col), F.array().cast("array<date>")

    def looking_back(months: int, days: int) -> Column:
        """Dates ``t`` with ``t - months - days`` equal to this row's date."""
        day = F.date_add(here, days)
        first = F.trunc(F.add_months(F.trunc(day, "month"), months), "month")
        start, last = F.date_add(first, F.dayofmonth(day) - 1), F.last_day(first)
        dates = F.when(day == F.last_day(day), F.sequence(F.least(start, last), last)).otherwise(F.array(start))
        return F.when(start <= last, dates).otherwise(no_dates) if months else F.array(day)

    def sent(number: int, dates: Column) -> Column:
        return F.transform(dates, lambda d: F.struct(F.lit(number).alias("n"), d.alias("d")))

    to = F.concat(sent(-1, F.array(here)), *[sent(i, looking_back(*shifts[n])) for i, n in enumerate(names)])
    rows = df.withColumn("__to", F.explode(to))
    own = F.when(F.col("__to.n") == -1, F.struct(F.lit(1).alias("__own"), *others))
    grouped = rows.groupBy(*keys, F.col("__to.d").alias(date_col)).agg(
        F.first(own, ignorenulls=True).alias("__row"),
        *[F.first(F.when(F.col("__to.n") == i, F.col(value)), ignorenulls=True).alias(n) for i, n in enumerate(names)],
    )
    kept = grouped.where("__row IS NOT NULL")
    return kept.select(*[F.col(f"__row.{c}").alias(c) if c in others else F.col(c) for c in df.columns], *names)


def period_shift(
    df: DataFrame, date_col: str, value: str, out: str, months: int = 0, days: int = 0, keys: Sequence[str] = ()
) -> DataFrame:
    """One earlier period, see :func:`period_shifts`."""
    return period_shifts(df, date_col, value, {out: (months, days)}, keys)


def trailing(df: DataFrame, date_col: str, as_of: date, days: int = 30) -> DataFrame:
    """Rows of the last ``days`` days up to and including ``as_of``."""
    first = as_of - timedelta(days=days - 1)
    return df.filter(F.col(date_col).between(F.lit(first), F.lit(as_of)))


def rolling_sums(
    daily: DataFrame, date_col: str, values: dict[str, Column], days: int, keys: Sequence[str]
) -> DataFrame:
    """Sums over the ``days`` days ending at each row, per key.

    ``daily`` has one row per key and day, so a key's window holds at most as
    many rows as the calendar has days, however hot the key is.
    """
    day_number = F.datediff(F.col(date_col), F.lit(date(1970, 1, 1)))
    window = Window.partitionBy(*keys).orderBy(day_number).rangeBetween(-(days - 1), 0)
    return daily.select("*", *[F.sum(v).over(window).alias(out) for out, v in values.items()])


def last_value(df: DataFrame, keys: Sequence[str], value: str, order: Column, out: str) -> DataFrame:
    """Value at the greatest ``order`` among rows that have one."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.max_by(value, order).alias(out))


def cohort(df: DataFrame, who: str, when: str) -> DataFrame:
    """Active members per first-activity month and months since.

    Activity is first reduced to one row per member and month, so however many
    events a member has, their window holds at most one row per calendar month.
    """
    active = df.select(F.col(who).alias("who"), month_start(F.col(when)).alias("month")).distinct()
    since = active.withColumn("cohort", F.min("month").over(Window.partitionBy("who")))
    offset = F.months_between("month", "cohort").cast("int")
    # One row per member and month, so counting rows counts members.
    sizes = since.groupBy("cohort", offset.alias("offset")).agg(F.count(F.lit(1)).alias("active"))
    base = F.max(F.when(F.col("offset") == 0, F.col("active"))).over(Window.partitionBy("cohort"))
    return sizes.withColumn("base", base)
