"""Division and rounding with the same answer on every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Ratio as double; NULL when the denominator is zero or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def round_ratio(value: Column, digits: int = 4) -> Column:
    """Round a double half up.  Plain ``round`` on doubles differs between engines."""
    scale = float(10**digits)
    return F.floor(value * scale + 0.5).cast("double") / F.lit(scale)


def ratio(numerator: Column, denominator: Column, digits: int = 4) -> Column:
    """Rounded safe division."""
    return round_ratio(safe_divide(numerator, denominator), digits)


def sum_if(condition: Column, value: Column) -> Column:
    """Sum of ``value`` over rows meeting ``condition``; NULL when there is none."""
    return F.sum(F.when(condition, value))


def count_if_distinct(condition: Column, value: Column) -> Column:
    return F.count_distinct(F.when(condition, value))
