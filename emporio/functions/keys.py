"""Hash keys over text renderings of columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "DESCONHECIDO"
NO_CAMPAIGN = "SEM_CAMPANHA"
ANONYMOUS = "ANONIMO"
UNKNOWN_DATE = -1


def _digest(columns: tuple[Column | str, ...], separator: str, null_text: str) -> Column:
    parts = [F.coalesce(_col(c).cast("string"), F.lit(null_text)) for c in columns]
    return F.md5(F.concat_ws(separator, *parts))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*columns: Column | str) -> Column:
    """MD5 of the natural key, parts joined by ``-`` and NULL spelled ``NULL``."""
    return _digest(columns, "-", "NULL")


def row_hash(*columns: Column | str) -> Column:
    """MD5 of the tracked attributes, parts joined by ``|`` and NULL as empty text."""
    return _digest(columns, "|", "")


def date_key(day: Column | str) -> Column:
    """Integer ``YYYYMMDD``."""
    d = _col(day)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)
