"""Every source table through the one staging builder."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from conftest import at, source_rows
from emporio.plans.staging import build_staging
from emporio.registry import TABLES, TABLES_BY_NAME


def value(column, n):
    """A distinct value of the column's type; text needs cleaning."""
    if isinstance(column.dtype, T.StringType):
        return f"  MiX{n} "
    if isinstance(column.dtype, T.IntegerType):
        return n
    if isinstance(column.dtype, T.DecimalType):
        return Decimal(n) / 10
    if isinstance(column.dtype, T.BooleanType):
        return bool(n % 2)
    if isinstance(column.dtype, T.DateType):
        return date(2024, 1, 1) + timedelta(days=n)
    return datetime(2024, 1, 1) + timedelta(days=n)


def cleaned(column, raw):
    rules = {"trim": str.strip, "lower": lambda s: s.lower().strip(), "upper": lambda s: s.strip().upper()}
    return rules[column.clean](raw) if column.clean else raw


@pytest.mark.parametrize("entry", TABLES, ids=lambda e: e.full_name)
def test_newest_version_typed_and_cleaned(spark, entry):
    key = {c.name: value(c, 1) for c in entry.columns if c.name in entry.natural_key}
    rows = []
    for version, changed in ((5, "2026-01-01"), (7, "2026-01-03"), (6, "2026-01-02")):
        row = {c.name: value(c, version) for c in entry.columns}
        rows.append({**row, **key, "updated_at": at(changed)})
    other = {**rows[0], **{entry.natural_key[0]: value(entry.columns[0], 2) if entry.columns[0].name == entry.natural_key[0] else 2}}
    source = source_rows(spark, entry.full_name, [*rows, other], "2026-01-05")
    out = build_staging(source, entry)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in entry.staging_schema]
    kept = {r[entry.natural_key[0]]: r for r in out.collect()}
    assert len(kept) == 2
    newest = kept[key[entry.natural_key[0]]]
    for c in entry.columns:
        if c.name not in entry.natural_key and not isinstance(c.dtype, T.TimestampType):
            assert newest[c.name] == cleaned(c, value(c, 7)), c.name


def test_double_ids_round_half_to_even(spark):
    entry = TABLES_BY_NAME["produtos.categorias"]
    df = spark.sql("SELECT * FROM VALUES (2.5D, ' a ', null, '2026-01-01', '2026-01-02'), (3.5D, 'b', null, '2026-01-01', '2026-01-02') "
                   "t(id_categoria, nome, subcategoria, updated_at, _ingested_at)")
    assert sorted((r["id_categoria"], r["nome"]) for r in build_staging(df, entry).collect()) == [(2, "a"), (4, "b")]
