"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Portuguese labels, January first and Sunday first.
MONTHS = ("Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho", "Julho", "Agosto",
          "Setembro", "Outubro", "Novembro", "Dezembro")
WEEKDAYS = ("Domingo", "Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira",
            "Sexta-feira", "Sábado")


def weekday(day: Column) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(day) - 1


def label(labels: tuple[str, ...], position: Column) -> Column:
    """Pick the label at a zero-based ``position``."""
    return F.element_at(F.array(*[F.lit(t) for t in labels]), (position + 1).cast("int"))


def month_name(day: Column) -> Column:
    return label(MONTHS, F.month(day) - 1)


def weekday_name(day: Column) -> Column:
    return label(WEEKDAYS, weekday(day))


def is_weekend(day: Column) -> Column:
    return weekday(day).isin(0, 6)


def is_black_friday(day: Column) -> Column:
    """A Friday of November on or after the 22nd whose next Friday is in December."""
    return (
        (F.month(day) == 11)
        & (weekday(day) == 5)
        & (F.dayofmonth(day) >= 22)
        & (F.month(F.date_add(day, 7)) == 12)
    )


def quarter_label(day: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(day).cast("string"))


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def year_quarter(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("-"), quarter_label(day))


def half_year(day: Column) -> Column:
    return F.when(F.month(day) <= 6, 1).otherwise(2)


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def easter(year: Column) -> Column:
    """Easter Sunday of a Gregorian year (the anonymous computus)."""

    def div(a: Column, b: int) -> Column:
        return F.floor(a / b)

    golden = year % 19
    century, in_century = div(year, 100), year % 100
    correction = div(century - div(century + 8, 25) + 1, 3)
    epact = (golden * 19 + century - div(century, 4) - correction + 15) % 30
    offset = ((century % 4) * 2 + div(in_century, 4) * 2 - epact - in_century % 4 + 32) % 7
    shift = div(golden + epact * 11 + offset * 22, 451)
    days = epact + offset - shift * 7 + 114
    return F.make_date(year.cast("int"), div(days, 31).cast("int"), (days % 31 + 1).cast("int"))
