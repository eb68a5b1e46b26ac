"""Registered queries against their SQL; ``EMPORIO_ALL_QUERIES=1`` runs every one."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as contract  # noqa: E402
from catalog import ALL  # noqa: E402
from catalog.registry import with_clause  # noqa: E402

DATA = "/root/testdata/sf0.001"
SAMPLE = ("stg_dedup_latest", "dim_customer_scd", "fact_sales", "fact_session", "fact_budget", "measures_sales_by_channel",
          "measures_stock", "retention", "abc_curve", "scd2_apply", "reconcile", "date_spine")
NAMES = sorted(ALL) if os.getenv("EMPORIO_ALL_QUERIES") else SAMPLE


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(DATA):
        pytest.skip("test data not present")
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return con


def test_contract():
    assert set(contract.oracle_sql()) <= set(contract.queries()) and len(contract.queries()) > 90
    # Of the library's own queries; subpackages that may be absent have rules of their own.
    assert set(ALL) <= set(contract.queries())
    assert [n for n in ALL if n not in contract.oracle_sql()] == []


def test_with_clause_orders_definitions():
    text = with_clause("SELECT * FROM mod_orcamento")
    assert text.index("mod_itens AS") < text.index("mod_pedidos AS") < text.index("mod_venda AS") < text.index("mod_orcamento AS")


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    df = ALL[name].run(spark, DATA)
    sql = ALL[name].oracle()
    if sql is None:
        assert df.count() > 0
        return
    expected = duck.sql(sql)
    assert expected.columns == df.columns
    assert sorted(str(tuple(r)) for r in df.collect()) == sorted(str(r) for r in expected.fetchall())


def test_entry(spark, duck):
    assert "receita_liquida" in contract.entry(spark).columns
