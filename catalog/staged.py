"""Every staging table through the builder a stored run uses, from rows as they land.

The landed rows are those of the source view with padded text in the wrong case, dates as text and whole numbers as
doubles, as a NULL in a batch leaves them; each key has an older version besides that was landed later and must lose.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.registry import query
from catalog.source_views import VIEWS
from emporio.plans.staging import build_staging
from emporio.registry import TABLES, Column, TableEntry

_DIRTY = {
    "trim": lambda c: F.concat(F.lit("  "), c, F.lit(" ")),
    "lower": lambda c: F.concat(F.lit(" "), F.upper(c), F.lit("  ")),
    "upper": lambda c: F.concat(F.lit(" "), F.lower(c)),
}
_CLEAN_SQL = {None: "{0}", "trim": "trim({0})", "lower": "lower(trim({0}))", "upper": "upper(trim({0}))"}


def _letter(dtype: T.DataType) -> str:
    if isinstance(dtype, T.IntegralType):
        return "l"
    return {T.DecimalType: "d", T.BooleanType: "b"}.get(type(dtype), "s")


def _landed(source: DataFrame, entry: TableEntry) -> DataFrame:
    def raw(column):
        value = F.col(column.name)
        if column.clean:
            value = _DIRTY[column.clean](value)
        if isinstance(column.dtype, T.IntegralType):
            value = value.cast("double")
        if isinstance(column.dtype, (T.DateType, T.TimestampType, T.BooleanType)) and column.name != entry.watermark_col:
            value = value.cast("string")
        return value.alias(column.name)

    newest = source.select(*[raw(c) for c in _given(entry)], "_ingested_at")
    day = F.expr("INTERVAL 1 DAY")
    stamps = {"updated_at": F.col("updated_at") - day, "_ingested_at": F.col("_ingested_at") + day}
    older = newest.select(
        *[
            stamps[f.name].alias(f.name) if f.name in stamps
            else F.col(f.name) if f.name in entry.natural_key
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in newest.schema
        ]
    )
    rows = older.unionByName(newest)
    # What the given tables have nothing to derive from lands as NULL.
    return rows.select("*", *[F.lit(None).cast("string").alias(c.name) for c in entry.columns if c.name not in rows.columns])


def _given(entry: TableEntry) -> list[Column]:
    return [c for c in entry.columns if re.search(rf"\b{c.name}\b", VIEWS[entry.full_name])]


def _sql(entry: TableEntry) -> str:
    columns = [(c, f'"{c.name}"') for c in _given(entry)]
    cleaned = ", ".join(f"{_CLEAN_SQL[c.clean].format(n)} AS {n}" for c, n in columns)
    ties = [n for c, n in columns if c.name not in (*entry.natural_key, "updated_at")]
    order = ", ".join(f"s.{n} DESC NULLS LAST" for n in ('"updated_at"', '"_ingested_at"', *ties))
    return f"""SELECT {cleaned} FROM src_{entry.watermark_key} s
        QUALIFY row_number() OVER (PARTITION BY {", ".join("s." + k for k in entry.natural_key)} ORDER BY {order}) = 1"""


def _register(table: TableEntry) -> None:
    # Ids of the given tables outgrow 32 bits.
    entry = table.widened()
    columns = " ".join(f"{c.name}:{_letter(c.dtype)}" for c in _given(entry))

    @query(f"staged_{table.schema}_{table.table}", columns, _sql(entry))
    def staged(m):
        return build_staging(_landed(m.source(table.full_name), entry), entry)


for _table in TABLES:
    _register(_table)
