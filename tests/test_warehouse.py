"""The stored warehouse: incremental runs equal a rebuild."""

from dataclasses import replace
from datetime import date
from decimal import Decimal
from functools import partial

import pytest
from pyspark.sql import functions as F

from conftest import at, source_rows
from emporio.config import WarehouseConfig
from emporio.jobs import ingest, monitor, transform
from emporio.plans.dimensions import build_store
from emporio.plans.warehouse import Transform
from emporio.quality.freshness import bronze_freshness, check_volume, gold_freshness
from emporio.quality.reconcile import reconcile, select_checks
from emporio.registry import TABLES_BY_NAME
from emporio.sinks.bronze import append_bronze
from emporio.sinks.control import WatermarkLog
from emporio.sinks.export import append_audit, export, run_all
from emporio.sinks.tables import Warehouse
from test_models import TABLES, item, order

D = Decimal


def land(spark, root, when, tables):
    def one(name, rows):
        append_bronze(source_rows(spark, name, rows), TABLES_BY_NAME[name], root, at(when), len(rows))

    assert all(r.ok for r in run_all({n: partial(one, n, rows) for n, rows in tables.items()}, 8))


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    bronze = str(base / "bronze")
    cfg = WarehouseConfig(bronze_root=bronze, warehouse_root=str(base / "incremental"), as_of=date(2026, 7, 20))
    land(spark, bronze, "2026-07-19 05:00", TABLES)
    first = Transform(spark, cfg).run()["fato_venda"].count()
    stock = dict(TABLES["estoque.saldo_estoque"][0])
    changes = {
        # A return weeks after the sale, a new item on an old order, a new order, a paid receivable,
        # a late cart event, a next stock snapshot, a commission.
        "vendas.devolucoes": [dict(id_devolucao=9, id_pedido=6, id_produto=1, qtd_devolvida=1, valor_devolvido=D("5.00"), status="aprovada")],
        "vendas.itens_pedido": [item(51, 5), item(81, 8)],
        "vendas.pedidos": [order(8, id_cliente=6, dt_pedido=at("2026-07-19"))],
        "financeiro.contas_receber": [{**TABLES["financeiro.contas_receber"][1], "status": "pago", "updated_at": at("2026-07-19")}],
        "web_analytics.eventos_carrinho": [dict(id_evento=50, id_sessao=2, id_produto=3, tipo_evento="add_to_cart")],
        "estoque.saldo_estoque": [{**stock, "qtd_disponivel": 0, "dt_ultima_atualizacao": date(2026, 7, 19), "updated_at": at("2026-07-19")}],
        "rh.comissoes": [dict(id_comissao=3, id_vendedor=1, id_pedido=3, valor_venda=D("9.00"), valor_comissao=D("4.00"), status="pago")],
        "financeiro.lancamentos": [dict(id_lancamento=4, id_pedido=None, id_loja=1, tipo="receita", valor=D("1.00"), dt_lancamento=date(2026, 7, 19), dt_competencia=date(2026, 7, 19))],
    }
    land(spark, bronze, "2026-07-20 05:00", changes)
    incremental = Transform(spark, cfg).run()
    full = Transform(spark, replace(cfg, warehouse_root=str(base / "full"), full_refresh=True)).run()
    return cfg, first, incremental, full


def content(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_incremental_equals_full_refresh(runs):
    _, _, incremental, full = runs
    assert set(incremental) == set(full) and len(full) == 28 + 3 + 10 + 6
    different = [n for n in full if content(incremental[n]) != content(full[n])]
    assert different == []


def test_late_changes_reached_the_facts(runs):
    _, first, incremental, _ = runs
    sales = {r["id_item_pedido_dg"]: r for r in incremental["fato_venda"].collect()}
    assert len(sales) == first + 2
    assert not sales[61]["fl_venda_valida"] and sales[61]["status"] == "devolvido"
    assert sales[31]["valor_comissao"] == D("4.00")
    assert incremental["fato_estoque"].filter("id_produto_nk = 1").count() == 2  # snapshots accumulate
    flags = {r["id_lancamento_dg"]: r["fl_pago"] for r in incremental["fato_financeiro"].collect()}
    assert flags == {1: True, 2: True, 3: None, 4: None}
    session = incremental["fato_cliente_interacao"].filter("id_sessao_dg = 2").first()
    assert session["fl_abandono_carrinho"] is True


def test_nothing_new_changes_nothing(spark, runs):
    cfg, _, incremental, _ = runs
    before = {n: content(incremental[n]) for n in ("fato_venda", "int_vendas__pedidos_unificados", "stg_vendas__pedidos")}
    again = Transform(spark, cfg).run()
    assert {n: content(again[n]) for n in before} == before


def test_incremental_equals_a_rebuild_whatever_lands_when(spark, tmp_path):
    """Two stock snapshots and a late movement in one run, a product after its sale, a table landing late with an old stamp."""
    bronze = str(tmp_path / "bronze")
    cfg = WarehouseConfig(bronze_root=bronze, warehouse_root=str(tmp_path / "w"), as_of=date(2026, 7, 20))
    late = {"produtos.produtos", "rh.comissoes"}
    land(spark, bronze, "2026-07-17 05:00", {n: rows for n, rows in TABLES.items() if n not in late})
    Transform(spark, cfg).run()
    # Lands after the first run looked, with the stamp of the batch it belongs to.
    land(spark, bronze, "2026-07-17 05:00", {n: TABLES[n] for n in late})
    stock, move = dict(TABLES["estoque.saldo_estoque"][0]), dict(TABLES["estoque.movimentacoes"][0])
    days = [date(2026, 7, 17), date(2026, 7, 18)]
    land(spark, bronze, "2026-07-18 05:00", {
        "estoque.saldo_estoque": [{**stock, "qtd_disponivel": k, "dt_ultima_atualizacao": d, "updated_at": at(f"{d} 10:00")} for k, d in enumerate(days)],
        "estoque.movimentacoes": [{**move, "id_movimentacao": 900, "updated_at": at("2026-07-18")}],
    })
    incremental = Transform(spark, cfg).run()
    full = Transform(spark, replace(cfg, warehouse_root=str(tmp_path / "full"), full_refresh=True)).run()
    assert [n for n in full if content(incremental[n]) != content(full[n])] == []
    assert incremental["fato_estoque"].filter("id_produto_nk = 1").count() == 3
    assert incremental["fato_venda"].filter("sk_produto = 'DESCONHECIDO'").count() == full["fato_venda"].filter("sk_produto = 'DESCONHECIDO'").count()


def test_storage_is_cleaned_up(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path), kept_snapshots=2)
    part = F.floor(F.col("id") / 10)
    for k in range(4):
        w.overwrite(spark.range(3), "whole")
        w.upsert(spark.range(k, k + 2), "parts", ["id"], partition=part)
    assert sorted(p.name for p in (tmp_path / "whole").iterdir()) == ["_commits", "snapshot=3", "snapshot=4"]
    assert sorted(p.name for p in (tmp_path / "parts").iterdir()) == ["_commits", "snapshot=1"]
    assert w.read("parts").count() == 5


def test_versions_are_kept_when_asked(spark, runs, tmp_path):
    cfg, _, incremental, _ = runs
    first = Transform(spark, replace(cfg, warehouse_root=str(tmp_path), keep_versions=True))
    first._store_dimension("dim_loja", build_store(incremental, cfg))
    later = Transform(spark, replace(first.cfg, as_of=date(2026, 7, 21)))
    changed = incremental["stg_rh__lojas"].withColumn("gerente", F.when(F.col("id_loja") == 1, "Outra"))
    later._store_dimension("dim_loja", build_store({"stg_rh__lojas": changed}, cfg))
    versions = later.frames["dim_loja"].filter("id_loja_nk = 1").orderBy("valid_from").collect()
    assert [(r["gerente"], r["valid_to"], r["fl_current"]) for r in versions] == [
        ("G", date(2026, 7, 20), False), ("Outra", date(9999, 12, 31), True)]


def test_reconciliation(spark, runs):
    _, _, gold, _ = runs
    source = {e: gold[t.staging_name] for e, t in TABLES_BY_NAME.items()}
    rows = {r["check"]: r for r in reconcile(gold, source, date(2026, 7, 20)).collect()}
    assert len(rows) == 8
    assert {n for n, r in rows.items() if not r["passed"]} == {"fato_estoque.count"}
    short = {**gold, "fato_orcamento": gold["fato_orcamento"].limit(1)}
    checks = select_checks("fato_orcamento")
    bad = {r["check"]: r["deviation"] for r in reconcile(short, source, date(2026, 7, 20), checks).collect()}
    assert bad["fato_orcamento.count"] == 0.5
    loose = reconcile(short, source, date(2026, 7, 20), select_checks("fato_orcamento.count", 0.6)).first()
    assert loose["passed"]
    gone = {**gold, "fato_orcamento": gold["fato_orcamento"].limit(0)}
    lost = {r["check"]: r for r in reconcile(gone, source, date(2026, 7, 20), checks).collect()}
    assert lost["fato_orcamento.receita_meta"]["deviation"] == float("inf")
    with pytest.raises(ValueError):
        select_checks("nada")


def test_freshness_and_volume(spark, runs, tmp_path):
    cfg, _, gold, _ = runs
    WatermarkLog(spark, cfg.bronze_root).commit(TABLES_BY_NAME["vendas.pedidos"], at("2020-01-01"), at("2099-01-01"))
    # Files were just written by this test, so they are fresh today and stale in a year.
    stale = {r["check"]: r["passed"] for r in bronze_freshness(spark, cfg.bronze_root, at("2098-12-31")).collect()}
    assert stale["bronze:vendas.pedidos"] and not stale["bronze:vendas.itens_pedido"] and len(stale) == 7
    empty = bronze_freshness(spark, str(tmp_path), at("2026-01-01")).collect()
    assert not any(r["passed"] for r in empty)
    judged = {r["check"]: r["passed"] for r in gold_freshness(gold, at("2026-07-20 06:00")).collect()}
    assert judged["gold:fato_venda"] and not judged["gold:fato_entrega"] and len(judged) == 4
    volume = {r["check"]: r for r in check_volume(spark, cfg.bronze_root, date(2026, 7, 20)).collect()}
    assert volume["batch:estoque.saldo_estoque"]["passed"] and not volume["batch:vendas.pedidos"]["passed"]
    assert volume["batch:clientes.clientes"]["observed"] == "None" and volume["batch:vendas.pedidos"]["severity"] == "warning"


def test_export_audit_and_statistics(spark, runs, tmp_path):
    cfg, _, gold, _ = runs
    export({"dim_loja": gold["dim_loja"]}, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/dim_loja")).count() == 2
    assert any("zstd" in p.name for p in (tmp_path / "out/dim_loja").iterdir())
    row = spark.createDataFrame([("dim_loja", 2)], "tabela string, linhas int")
    append_audit(row, str(tmp_path / "audit"))
    append_audit(row, str(tmp_path / "audit"))
    assert spark.read.json(str(tmp_path / "audit")).count() == 2
    t = Transform(spark, cfg)
    table = t.warehouse.register("dim_transportadora", "emporio_test_carrier")
    t.warehouse.analyze(table)
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    assert "1 rows" in detail["Statistics"]
    spark.sql(f"DROP TABLE {table}")


def test_command_line_jobs(spark, runs, tmp_path, capsys):
    cfg, _, _, _ = runs
    roots = ["--bronze", cfg.bronze_root, "--warehouse", cfg.warehouse_root]
    assert ingest.main(["--mode", "full", "--table", "rh.nada"]) == 1
    assert "rh.nada" in capsys.readouterr().err
    assert transform.main([*roots, "--as-of", "2026-07-20"]) == 1  # mandatory tables without any file
    assert "marketing.leads" in capsys.readouterr().err
    land(spark, cfg.bronze_root, "2026-07-20 06:00", {
        "financeiro.parcelas": [dict(id_parcela=1, id_lancamento=1, numero_parcela=1, valor_parcela=D("9.00"), status="pago")],
        "marketing.leads": [dict(id_lead=1, id_campanha=7)],
        "marketing.atribuicao": [dict(id_atribuicao=1, id_pedido=6, id_campanha=7)],
    })
    out = str(tmp_path / "gold")
    assert transform.main([*roots, "--as-of", "2026-07-20", "--skip-tests", "--export", out]) == 0
    assert len(list((tmp_path / "gold").iterdir())) == 16
    assert monitor.main(["freshness", *roots, "--tolerance-hours", "1", "--output", str(tmp_path / "report")]) == 1
    report = spark.read.json(str(tmp_path / "report"))
    assert report.filter("severity = 'error'").count() == 11 and report.filter("severity = 'warning'").count() == 8
