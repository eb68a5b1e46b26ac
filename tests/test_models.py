"""All models over hand-made rows: NULLs, ties, missing dimensions, zero denominators, late rows."""

from dataclasses import replace
from datetime import date
from decimal import Decimal

import pytest

from conftest import at, day, rows_by, staged
from emporio.config import WarehouseConfig
from emporio.functions.keys import surrogate_key
from emporio.operators.joins import orphans
from emporio.plans.facts import build_sales, build_stock, sales_by_natural, stock_by_natural
from emporio.plans.measures import Context, evaluate, freight_share_by_order, measure
from emporio.plans.star import RELATIONSHIPS, Star
from emporio.plans.warehouse import build_all
from emporio.quality.rules import check_models
from pyspark.sql import functions as F

D = Decimal
CFG = WarehouseConfig(as_of=date(2026, 7, 20))


def order(i, **kw):
    base = dict(id_pedido=i, id_cliente=1, id_loja=1, canal_venda="loja_fisica", status="entregue",
                dt_pedido=at("2026-07-01 23:30"), valor_bruto=D("100.00"), valor_desconto=D("10.00"),
                valor_frete=D("5.00"), valor_liquido=D("95.00"), parcelas=1, metodo_pagamento="pix")
    return {**base, **kw}


def item(i, order_id, **kw):
    base = dict(id_item_pedido=i, id_pedido=order_id, id_produto=1, qtd_vendida=2, preco_unitario=D("50.00"),
                custo_unitario=D("30.00"), desconto_item=D("10.00"), valor_liquido_item=D("90.00"))
    return {**base, **kw}


TABLES = {
    "vendas.pedidos": [
        order(1),
        order(2, status="cancelado", id_campanha=7),
        order(3, status="enviado", canal_venda="site_proprio"),
        order(4, id_cliente=99, id_loja=99, canal_venda="quiosque", id_campanha=99, dt_pedido=at("2030-01-01")),
        order(5, valor_bruto=D("0.00"), valor_desconto=D("0.00"), status="confirmado"),  # no items
        order(6, id_cliente=2, dt_pedido=at("2026-06-20"), valor_liquido=D("15000.00"), id_campanha=7),
    ],
    "vendas.itens_pedido": [
        item(11, 1), item(12, 1, id_produto=77), item(21, 2), item(31, 3),
        item(41, 4, desconto_item=D("0.00"), valor_liquido_item=D("0.00"), qtd_vendida=0), item(61, 6),
    ],
    "vendas.devolucoes": [
        dict(id_devolucao=1, id_pedido=2, id_produto=1, qtd_devolvida=1, valor_devolvido=D("45.00"), status="aprovada"),
        dict(id_devolucao=2, id_pedido=3, id_produto=1, qtd_devolvida=1, valor_devolvido=D("45.00"), status="aprovada"),
        dict(id_devolucao=3, id_pedido=1, id_produto=1, qtd_devolvida=1, valor_devolvido=D("45.00"), status="rejeitada"),
    ],
    "clientes.clientes": [
        dict(id_cliente=1, cpf="111", email="a@x", nome_completo="A", cep="1", cidade="C1", uf="SP", data_cadastro=day("2024-01-02"), ativo=True),
        dict(id_cliente=2, cpf="222", email="b@x", nome_completo="B", cep="2", cidade="C2", uf="RJ", data_cadastro=day("2024-01-03"), ativo=True),
        dict(id_cliente=3, cpf="222", email="c@x", nome_completo="C", cep="3", cidade="C3", uf="MG", data_cadastro=day("2024-01-01"), ativo=True),
        dict(id_cliente=4, cpf="", email="d@x", nome_completo="D", data_cadastro=day("2024-01-01"), ativo=True),
        dict(id_cliente=5, cpf=None, email="e@x", nome_completo="E", data_cadastro=day("2024-01-01"), ativo=True),
        dict(id_cliente=6, cpf="666", email="f@x", nome_completo="F", uf="BA", data_cadastro=day("2024-01-01"), ativo=False),
    ],
    "clientes.enderecos": [
        dict(id_endereco=1, id_cliente=1, cep="9", cidade="Old", uf="PR", tipo="principal", updated_at=at("2025-01-01")),
        dict(id_endereco=2, id_cliente=1, cep="8", cidade=None, uf="SC", tipo="principal", updated_at=at("2025-06-01")),
        dict(id_endereco=3, id_cliente=6, cep="7", cidade="X", uf="XX", tipo="entrega"),
    ],
    "clientes.techpoints": [dict(id_techpoints=1, id_cliente=1, pontos_acumulados=9, pontos_resgatados=2, saldo_pontos=7, nivel_fidelidade="Bronze")],
    "produtos.produtos": [
        dict(id_produto=1, id_categoria=1, id_fornecedor=1, sku="S1", nome="P1", marca="M", ativo=True),
        dict(id_produto=2, id_categoria=9, id_fornecedor=9, sku="S2", nome="P2", marca="M", ativo=True),
        dict(id_produto=3, id_categoria=1, id_fornecedor=1, sku="S3", nome="P3", marca="N", ativo=True),
    ],
    "produtos.categorias": [dict(id_categoria=1, nome="Cat")],
    "produtos.fornecedores": [
        dict(id_fornecedor=1, nome_fornecedor="F1", pais_origem="Brasil", ativo=True),
        dict(id_fornecedor=2, nome_fornecedor="F2", pais_origem="China", ativo=True),
    ],
    "produtos.precos": [
        dict(id_preco=1, id_produto=1, preco_venda=D("40.00"), custo_unitario=D("30.00"), dt_vigencia_inicio=day("2024-01-01"), dt_vigencia_fim=day("2026-07-19")),
        dict(id_preco=2, id_produto=1, preco_venda=D("50.00"), custo_unitario=D("30.00"), dt_vigencia_inicio=day("2025-01-01")),
        dict(id_preco=3, id_produto=1, preco_venda=D("60.00"), custo_unitario=D("30.00"), dt_vigencia_inicio=day("2027-01-01")),
        dict(id_preco=4, id_produto=3, preco_venda=D("0.00"), custo_unitario=D("1.00"), dt_vigencia_inicio=day("2024-01-01"), dt_vigencia_fim=day("2026-07-20")),
    ],
    "rh.lojas": [
        dict(id_loja=1, codigo="L1", nome_loja="Loja 1", tipo_loja="fisica", regiao="Sul", uf="PR", gerente="G", dt_abertura=day("2020-01-01"), ativo=True),
        dict(id_loja=2, codigo="L2", nome_loja="Loja 2", tipo_loja="ecommerce", regiao="Sul", uf="PR", gerente=None, dt_abertura=day("2020-01-01"), ativo=True),
    ],
    "rh.vendedores": [dict(id_vendedor=1, id_loja=1, nome="V", cpf="9", cargo="vendedor", data_admissao=day("2021-01-01"), ativo=True),
                      dict(id_vendedor=2, id_loja=9, nome="W", cpf="8", cargo="gerente", data_admissao=day("2021-01-01"), ativo=True)],
    "rh.comissoes": [
        dict(id_comissao=1, id_vendedor=1, id_pedido=1, valor_venda=D("95.00"), valor_comissao=D("1.00"), status="pago"),
        dict(id_comissao=2, id_vendedor=2, id_pedido=1, valor_venda=D("95.00"), valor_comissao=D("2.50"), status="pago"),
    ],
    "marketing.campanhas": [dict(id_campanha=7, nome="C", tipo="natal", canal="email", dt_inicio=day("2026-06-15"), dt_fim=day("2026-06-15"), orcamento=D("100.00"), ativo=True)],
    "logistica.transportadoras": [dict(id_transportadora=1, nome="T", prazo_dias_min=1, prazo_dias_max=4, ativo=True)],
    "logistica.modalidades": [
        dict(id_modalidade=1, id_transportadora=1, nome="Retira", codigo="R", prazo_dias=1, frete_base=D("0.00"), tipo="loja"),
        dict(id_modalidade=2, id_transportadora=8, nome="Sedex", codigo="X", prazo_dias=3, frete_base=D("9.00"), tipo="correios"),
    ],
    "logistica.entregas": [
        dict(id_entrega=1, id_pedido=3, id_transportadora=1, id_modalidade=1, id_loja_origem=1, dt_postagem=day("2026-07-02"), dt_promessa=day("2026-07-08"), dt_efetiva=day("2026-07-05"), fl_sla_atendido=True, status="entregue"),
        dict(id_entrega=2, id_pedido=4, id_transportadora=5, id_modalidade=5, id_loja_origem=5, dt_promessa=day("2026-07-08"), status="em_transito"),
        dict(id_entrega=3, id_pedido=6, id_transportadora=1, id_modalidade=2, id_loja_origem=2, dt_postagem=day("2026-07-02"), dt_promessa=day("2026-07-04"), dt_efetiva=day("2026-07-08"), fl_sla_atendido=False, status="entregue"),
    ],
    "estoque.saldo_estoque": [
        dict(id_saldo=1, id_produto=1, id_loja=1, qtd_disponivel=5, qtd_reservada=1, qtd_minima=5, dt_ultima_atualizacao=day("2026-07-01")),
        dict(id_saldo=2, id_produto=2, id_loja=9, qtd_disponivel=0, qtd_reservada=2, qtd_minima=5, dt_ultima_atualizacao=day("2026-07-02")),
    ],
    "estoque.movimentacoes": [
        dict(id_movimentacao=i, id_produto=1, id_loja=1, tipo_mov="ajuste", qtd=q, dt_movimentacao=at(t), id_pedido=p)
        for i, (q, t, p) in enumerate([(10, "2026-07-01 00:00", 1), (-3, "2026-07-01 23:59", 1), (0, "2026-07-01 12:00", None), (-4, "2026-07-02 00:00", 2)])
    ],
    "financeiro.lancamentos": [
        dict(id_lancamento=1, id_pedido=1, id_loja=1, tipo="receita", valor=D("95.00"), dt_lancamento=day("2026-07-01"), dt_competencia=day("2026-07-01")),
        dict(id_lancamento=2, id_pedido=1, id_loja=1, tipo="comissao", valor=D("3.00"), dt_lancamento=day("2026-07-01"), dt_competencia=day("2026-08-01")),
        dict(id_lancamento=3, id_pedido=None, id_loja=9, tipo="outro", valor=D("7.00"), dt_lancamento=day("2026-07-01"), dt_competencia=day("2040-01-01")),
    ],
    "financeiro.contas_receber": [
        dict(id_conta=1, id_pedido=1, valor_original=D("50.00"), valor_pago=D("50.00"), dt_vencimento=day("2026-07-10"), dt_pagamento=day("2026-07-09"), status="pago"),
        dict(id_conta=2, id_pedido=1, valor_original=D("45.00"), valor_pago=D("0.00"), dt_vencimento=day("2026-08-10"), dt_pagamento=day("2026-08-10"), status="pendente"),
    ],
    "financeiro.orcamentos": [
        dict(id_orcamento=1, id_loja=1, canal_venda="loja_fisica", ano=2026, mes=7, valor_meta_receita=D("100.00"), valor_meta_margem=D("0.00"), qtd_meta_pedidos=1),
        dict(id_orcamento=2, id_loja=1, canal_venda="site_proprio", ano=2026, mes=7, valor_meta_receita=D("0.00"), valor_meta_margem=D("50.00"), qtd_meta_pedidos=0),
    ],
    "web_analytics.sessoes": [
        dict(id_sessao=1, id_cliente=1, canal_origem="pago", device_type="mobile", dt_inicio=at("2026-07-01 10:00"), dt_fim=at("2026-07-01 10:45"), paginas_visitadas=3, converteu=False),
        dict(id_sessao=2, id_cliente=None, canal_origem="pago", device_type="mobile", dt_inicio=at("2026-07-01 10:00"), paginas_visitadas=1, converteu=False),
        dict(id_sessao=3, id_cliente=None, canal_origem="direto", device_type="mobile", dt_inicio=at("2026-07-01 10:00"), paginas_visitadas=1, converteu=True),
        dict(id_sessao=4, id_cliente=2, canal_origem="direto", device_type="mobile", dt_inicio=at("2026-07-01 10:00"), paginas_visitadas=1, converteu=True),
    ],
    "web_analytics.eventos_carrinho": [
        dict(id_evento=i, id_sessao=s, id_produto=p, tipo_evento=t)
        for i, (s, p, t) in enumerate([(1, 1, "add_to_cart"), (1, 1, "add_to_cart"), (1, 2, "remove_from_cart"), (4, 1, "add_to_cart"), (4, 1, "purchase")])
    ],
}


@pytest.fixture(scope="module")
def warehouse(spark):
    tables = build_all(staged(spark, TABLES), spark, CFG)
    for df in tables.values():
        df.cache()
    yield tables
    for df in tables.values():
        df.unpersist()


def key(spark, *values):
    return spark.range(1).select(surrogate_key(*[F.lit(v) for v in values])).first()[0]


def test_orders(warehouse):
    o = rows_by(warehouse["int_vendas__pedidos_unificados"], "id_pedido")
    assert {i: r["status"] for i, r in o.items()} == {
        1: "entregue", 2: "cancelado", 3: "devolvido", 4: "entregue", 5: "confirmado", 6: "entregue"}
    assert (o[1]["qtd_itens"], o[1]["qtd_total_produtos"], o[1]["custo_total"]) == (2, 4, D("120.00"))
    assert o[1]["margem_bruta"] == D("-25.00") and o[1]["taxa_desconto"] == 0.1
    assert (o[5]["qtd_itens"], o[5]["custo_total"], o[5]["taxa_desconto"]) == (0, 0, 0.0)
    assert o[2]["qtd_devolucoes"] == 1 and o[1]["qtd_devolucoes"] == 0
    assert o[1]["dt_pedido_data"] == date(2026, 7, 1)  # UTC day


def test_customers(warehouse):
    c = rows_by(warehouse["int_clientes__unificados"], "id_cliente")
    assert set(c) == {1, 3, 6}  # one per CPF, earliest registration; no CPF, no row
    assert (c[1]["cep"], c[1]["cidade"], c[1]["uf"]) == ("8", "C1", "SC")
    assert (c[6]["uf"], c[6]["qtd_pedidos"], c[6]["ltv"], c[6]["recencia_dias"], c[6]["score_recencia"]) == ("BA", 0, 0, None, 1)
    assert c[1]["qtd_pedidos"] == 3 and c[1]["nivel_fidelidade"] == "Silver"  # cancelled one left out
    assert c[1]["recencia_dias"] == 19 and c[1]["saldo_techpoints"] == 7 and c[6]["saldo_techpoints"] == 0


def test_catalog(warehouse):
    p = rows_by(warehouse["int_produtos__catalogo"], "id_produto")
    assert p[1]["preco_venda_vigente"] == D("60.00") and p[1]["margem_pct_vigente"] == 0.5  # latest start, future included
    assert p[2]["preco_venda_vigente"] is None and p[2]["categoria"] is None and p[2]["id_categoria"] is None
    assert p[3]["preco_venda_vigente"] == D("0.00") and p[3]["margem_pct_vigente"] is None


def test_dimensions(spark, warehouse):
    assert rows_by(warehouse["dim_campanha"], "id_campanha_nk")[7]["duracao_dias"] == 1
    assert rows_by(warehouse["dim_transportadora"], "id_transportadora_nk")[1]["prazo_medio_dias"] == 2.5
    modes = rows_by(warehouse["dim_modalidade_entrega"], "id_modalidade_nk")
    assert modes[1]["fl_retirada_loja"] and not modes[2]["fl_retirada_loja"] and modes[2]["nome_transportadora"] is None
    assert {r["nome_fornecedor"]: r["fl_importado"] for r in warehouse["dim_fornecedor"].collect()} == {"F1": False, "F2": True}
    stores = rows_by(warehouse["dim_loja"], "id_loja_nk")
    assert stores[1]["fl_loja_fisica"] and stores[2]["fl_ecommerce"] and stores[1]["sk_loja"] == key(spark, 1)
    assert rows_by(warehouse["dim_vendedor"], "id_vendedor_nk")[2]["nome_loja"] is None
    assert {r["valid_from"] for r in warehouse["dim_produto"].collect()} == {CFG.as_of}
    segments = rows_by(warehouse["dim_cliente"], "id_cliente_nk")
    assert segments[6]["segmento_rfm"] == "Perdidos"


def test_sales(spark, warehouse):
    s = rows_by(warehouse["fato_venda"], "id_item_pedido_dg")
    assert set(s) == {11, 12, 21, 31, 41, 61}
    assert s[11]["sk_venda"] == key(spark, 1, 11) and s[11]["sk_cliente"] == key(spark, 1)
    assert s[12]["sk_produto"] == "DESCONHECIDO" and s[11]["sk_campanha"] == "SEM_CAMPANHA"
    unknown = s[41]
    assert [unknown[k] for k in ("sk_cliente", "sk_loja", "sk_tempo", "sk_canal_venda", "sk_campanha")] == [
        "DESCONHECIDO", "DESCONHECIDO", -1, "DESCONHECIDO", "SEM_CAMPANHA"]
    assert unknown["taxa_desconto_item"] is None and s[11]["taxa_desconto_item"] == 0.1
    assert s[21]["fl_cancelado"] and s[21]["fl_devolvido"] and not s[21]["fl_venda_valida"]
    assert s[31]["fl_devolvido"] and s[31]["fl_online"] and not s[31]["fl_venda_valida"]
    assert s[11]["margem_bruta_item"] == D("30.00") and s[11]["valor_comissao"] == D("3.50")
    assert s[61]["sk_cliente"] == "DESCONHECIDO"  # the customer lost to an older record of the same CPF


def test_fan_out_is_optional(spark, warehouse):
    from emporio.plans.facts import build_ledger, build_sales

    wide = replace(CFG, fan_out=True)
    assert build_sales(warehouse, wide).filter("id_pedido_dg = 1").count() == 4
    assert warehouse["fato_venda"].filter("id_pedido_dg = 1").count() == 2
    assert build_ledger(warehouse, wide).count() == 5 and warehouse["fato_financeiro"].count() == 3


def test_stock(warehouse):
    s = rows_by(warehouse["fato_estoque"], "id_produto_nk")
    assert (s[1]["qtd_entrada_dia"], s[1]["qtd_saida_dia"], s[1]["qtd_pedidos_movs"]) == (10, 3, 1)
    assert s[1]["fl_estoque_critico"] and not s[1]["fl_ruptura"] and s[1]["qtd_total"] == 6
    assert s[2]["fl_ruptura"] and s[2]["sk_loja"] == "DESCONHECIDO" and s[2]["qtd_saida_dia"] == 0


def test_deliveries(warehouse):
    d = rows_by(warehouse["fato_entrega"], "id_entrega_dg")
    assert (d[1]["lead_time_prometido_dias"], d[1]["lead_time_real_dias"], d[1]["atraso_dias"]) == (6, 3, -3)
    assert (d[2]["lead_time_real_dias"], d[2]["atraso_dias"], d[2]["sk_tempo_postagem"]) == (None, None, -1)
    assert not d[2]["fl_entregue"] and d[2]["sk_transportadora"] == "DESCONHECIDO" and d[3]["atraso_dias"] == 4


def test_ledger(warehouse):
    e = rows_by(warehouse["fato_financeiro"], "id_lancamento_dg")
    assert {i: r["valor_sinal"] for i, r in e.items()} == {1: D("95.00"), 2: D("-3.00"), 3: D("7.00")}
    assert e[1]["status_cr"] == "pendente" and not e[1]["fl_pago"]
    assert e[3]["status_cr"] is None and e[3]["fl_pago"] is None and e[3]["sk_tempo_competencia"] == -1


def test_sessions_keep_three_valued_flag(warehouse):
    s = rows_by(warehouse["fato_cliente_interacao"], "id_sessao_dg")
    assert {i: r["fl_abandono_carrinho"] for i, r in s.items()} == {1: True, 2: None, 3: False, 4: False}
    assert s[1]["duracao_min"] == 45.0 and s[2]["duracao_min"] is None
    assert s[2]["sk_cliente"] == "ANONIMO" and s[2]["qtd_add_cart"] == 0
    assert (s[1]["qtd_produtos_vistos"], s[1]["qtd_add_cart"], s[1]["qtd_remove_cart"]) == (2, 2, 1)


def test_budget(warehouse):
    b = rows_by(warehouse["fato_orcamento"], "id_orcamento_dg")
    assert b[1]["receita_realizada"] == D("180.00") and b[1]["var_receita_pct"] == 0.8 and b[1]["var_margem_pct"] is None
    assert b[1]["fl_meta_receita_atingida"] and b[1]["qtd_pedidos_realizados"] == 1
    assert b[2]["receita_realizada"] == 0 and b[2]["var_receita_pct"] is None and b[2]["fl_meta_pedidos_atingida"]
    assert b[2]["var_margem_pct"] == -1.0


def test_every_fact_carries_its_ingestion_time(warehouse):
    assert all("_ingested_at" in warehouse[f].columns for f in RELATIONSHIPS)


def test_sentinels_are_the_only_orphans(warehouse):
    for fact, dims in RELATIONSHIPS.items():
        for dim, (fk, pk) in dims.items():
            lost = {r[0] for r in orphans(warehouse[fact], warehouse[dim], fk, pk).select(fk).distinct().collect()}
            assert lost <= {"DESCONHECIDO", "SEM_CAMPANHA", "ANONIMO", -1}, (fact, dim, lost)


def test_schema_rules_on_the_models(warehouse):
    failed = {(r["table"], r["rule"]) for r in check_models(warehouse).filter("not passed").collect()}
    # What the fixture breaks on purpose.
    assert failed == {
        ("stg_vendas__pedidos", "accepted:canal_venda"), ("stg_clientes__clientes", "not_null:cpf"),
        ("stg_clientes__clientes", "unique:cpf"), ("stg_financeiro__lancamentos", "accepted:tipo"),
        ("int_produtos__catalogo", "not_null:categoria"), ("int_produtos__catalogo", "not_null:preco_venda_vigente"),
        ("dim_produto", "not_null:categoria"), ("fato_financeiro", "accepted:tipo"),
    }


def test_measures(warehouse):
    star = Star(warehouse)
    ctx = Context(as_of=date(2026, 7, 20))
    names = ["receita_bruta", "receita_liquida", "total_pedidos", "taxa_devolucao", "clientes_ativos_90d", "cr_vencer",
             "cr_vencido", "otd_pct", "otd_entregues_pct", "atraso_medio", "giro_estoque", "roi_campanha"]
    row = evaluate(star, names, context=ctx).first()
    assert row["receita_bruta"] == D("400.00") and row["receita_liquida"] == D("450.00") and row["total_pedidos"] == 5
    assert row["taxa_devolucao"] == 2 / 5 and row["clientes_ativos_90d"] == 2
    assert row["cr_vencer"] == D("98.00") and row["cr_vencido"] is None
    assert row["otd_pct"] == pytest.approx(1 / 3) and row["otd_entregues_pct"] == 0.5 and row["atraso_medio"] == 4.0
    assert row["giro_estoque"] == 10 / 2.5 and row["roi_campanha"] == pytest.approx(0.8)
    by_kind = rows_by(evaluate(star, ["receita_liquida"], ["dim_loja.tipo_loja"]), "tipo_loja")
    assert by_kind["fisica"]["receita_liquida"] == D("450.00") and by_kind[None]["receita_liquida"] == 0
    only = measure("unidades_vendidas")(star, where=F.col("`dim_canal_venda.tipo_canal`") == "Digital",
                                        using=["dim_canal_venda.tipo_canal"]).first()
    assert only["unidades_vendidas"] == 2
    assert freight_share_by_order(star).first()[0] == pytest.approx(25 / 450)
    with pytest.raises(KeyError, match="nada"):
        measure("nada")


def test_measures_line_up_groups_missing_on_one_side(warehouse):
    rows = rows_by(evaluate(Star(warehouse), ["unidades_vendidas", "estoque_medio", "dias_cobertura"], ["sk_produto"]), "sk_produto")
    assert len(rows) == 3 and rows["DESCONHECIDO"]["estoque_medio"] is None
    assert sum(r["unidades_vendidas"] is None for r in rows.values()) == 1


def test_products_in_a_group_of_one_product_are_told_by_a_flag(spark):
    """Not one row per distinct count: no Expand where the groups are the products; other groups count as before."""
    rows = [("a", "x", True), ("a", "y", False), ("b", "x", False), ("c", "x", None), (None, "y", True), ("b", "x", False)]
    star = Star({"fato_estoque": spark.createDataFrame(rows, "sk_produto string, sk_loja string, fl_ruptura boolean")})
    by_product = evaluate(star, ["taxa_ruptura"], ["sk_produto"])
    assert {r["sk_produto"]: r["taxa_ruptura"] for r in by_product.collect()} == {"a": 1.0, "b": 0.0, "c": 0.0, None: None}
    assert "Expand" not in by_product._jdf.queryExecution().executedPlan().toString()
    by_store = rows_by(evaluate(star, ["taxa_ruptura"], ["sk_loja"]), "sk_loja")
    assert by_store["x"]["taxa_ruptura"] == pytest.approx(1 / 3) and by_store["y"]["taxa_ruptura"] == 0.0


@pytest.mark.parametrize("names", [["unidades_vendidas", "estoque_medio", "taxa_ruptura"], ["taxa_devolucao", "total_pedidos"]])
def test_groups_by_product_travel_under_the_natural_key(spark, warehouse, names):
    """A product that the dimension lacks, and one with a NULL id, are one group; no part of a sum carries 32 letters."""
    tables = staged(spark, TABLES | {"vendas.itens_pedido": [
        *TABLES["vendas.itens_pedido"], item(90, 1, id_produto=777), item(91, 1, id_produto=778), item(92, 3, id_produto=None)]})
    built = {**warehouse, **tables}
    wide = {f"fato_{n}__by_natural": f(built, CFG) for n, f in (("venda", sales_by_natural), ("estoque", stock_by_natural))}
    plain = {"fato_venda": build_sales(built, CFG), "fato_estoque": build_stock(built, CFG)}
    assert [set(wide[f"{n}__by_natural"].columns) - set(df.columns) for n, df in plain.items()] == [{"__id_produto"}] * 2
    before, now = (evaluate(Star({**built, **plain, **more}), names, ["sk_produto"]) for more in ({}, wide))
    assert before.columns == now.columns and sorted(map(str, before.collect())) == sorted(map(str, now.collect()))
    assert "DESCONHECIDO" in {r["sk_produto"] for r in now.collect()}
    plan = now._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [__id_produto#" in plan and "Aggregate [sk_produto#" not in plan


def test_a_replaced_fact_is_the_one_that_is_grouped(spark, warehouse):
    star = Star({**warehouse, "fato_venda__by_natural": sales_by_natural(warehouse, CFG)})
    none = star.replacing("fato_venda", warehouse["fato_venda"].filter("false"))
    assert evaluate(none, ["unidades_vendidas"], ["sk_produto"]).count() == 0
