import dataclasses

import pytest
from pyspark.sql import types as T

from emporio.registry import OPTIONAL_TABLES, TABLES, TABLES_BY_NAME, TableEntry, find


def test_entry_names():
    entry = TableEntry("vendas", "pedidos", ("id_pedido",))
    assert entry.full_name == "vendas.pedidos"
    assert entry.watermark_key == "vendas__pedidos"
    assert entry.staging_name == "stg_vendas__pedidos"
    assert entry.watermark_col == "updated_at"
    with pytest.raises(dataclasses.FrozenInstanceError):
        entry.schema = "x"


def test_registry_is_complete():
    assert len(TABLES) == len(TABLES_BY_NAME) == 28
    assert {t.schema for t in TABLES} == {
        "vendas", "clientes", "produtos", "estoque", "logistica", "financeiro", "marketing", "rh", "web_analytics"
    }
    assert len(OPTIONAL_TABLES) == 15 and set(OPTIONAL_TABLES) <= set(TABLES_BY_NAME)


def test_keys_are_columns_and_every_table_has_a_watermark():
    for t in TABLES:
        names = t.staging_schema.names
        assert t.natural_key and set(t.natural_key) <= set(names), t.full_name
        assert names[-2:] == ["updated_at", "_ingested_at"]
        assert len(names) == len(set(names))


def test_composite_keys():
    assert TABLES_BY_NAME["estoque.saldo_estoque"].natural_key == ("id_produto", "id_loja")
    assert TABLES_BY_NAME["produtos.precos"].natural_key == ("id_produto", "dt_vigencia_inicio")


def test_types_and_widened_ids():
    orders = TABLES_BY_NAME["vendas.pedidos"]
    assert orders.staging_schema["valor_frete"].dataType == T.DecimalType(10, 2)
    assert orders.staging_schema["id_pedido"].dataType == T.IntegerType()
    wide = orders.widened().staging_schema
    assert wide["id_pedido"].dataType == T.LongType() and wide["parcelas"].dataType == T.IntegerType()


def test_unknown_table_is_rejected_before_work_starts():
    assert find(None) == TABLES
    assert [e.full_name for e in find(["rh.lojas"])] == ["rh.lojas"]
    with pytest.raises(KeyError, match="rh.nada"):
        find(["rh.lojas", "rh.nada"])
