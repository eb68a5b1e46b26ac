"""The measure layer over the star."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from catalog.models import div
from catalog.registry import query
from emporio.functions.numeric import round_ratio
from emporio.plans import measures as ms
from emporio.plans.measures import Context, evaluate

AS_OF = date(2001, 7, 31)
CTX = Context(as_of=AS_OF, start=date(1995, 3, 1), end=date(1995, 6, 30))

SALES_SQL = f"""
    sum(preco_unitario * qtd_vendida) FILTER (NOT fl_cancelado) AS receita_bruta,
    sum(valor_liquido_item) AS receita_liquida, sum(valor_liquido_item) FILTER (fl_venda_valida) AS receita_liquida_valida,
    count(DISTINCT id_pedido_dg) AS total_pedidos, {div('sum(valor_liquido_item)', 'count(DISTINCT id_pedido_dg)')} AS ticket_medio,
    sum(qtd_vendida) AS unidades_vendidas,
    {div('sum(desconto_item)', 'sum(preco_unitario * qtd_vendida)')} AS taxa_desconto,
    {div('count(DISTINCT id_pedido_dg) FILTER (fl_devolvido)', 'count(DISTINCT id_pedido_dg)')} AS taxa_devolucao,
    sum(margem_bruta_item) AS margem_bruta_valor, {div('sum(margem_bruta_item)', 'sum(valor_liquido_item)')} AS margem_bruta_pct,
    sum(qtd_vendida * custo_unitario) AS cmv, {div('sum(valor_frete_pedido)', 'sum(valor_liquido_item)')} AS frete_pct_receita,
    count(DISTINCT sk_cliente) FILTER (fl_venda_valida AND dt_pedido_data >= DATE '2001-05-02') AS clientes_ativos_90d"""
SALES = ["receita_bruta", "receita_liquida", "receita_liquida_valida", "total_pedidos", "ticket_medio",
         "unidades_vendidas", "taxa_desconto", "taxa_devolucao", "margem_bruta_valor", "margem_bruta_pct", "cmv",
         "frete_pct_receita", "clientes_ativos_90d"]
SALES_TYPES = ("receita_bruta:d receita_liquida:d receita_liquida_valida:d total_pedidos:l ticket_medio:d unidades_vendidas:l "
               "taxa_desconto:d taxa_devolucao:d margem_bruta_valor:d margem_bruta_pct:d cmv:d frete_pct_receita:d "
               "clientes_ativos_90d:l")


@query("measures_sales", SALES_TYPES, f"SELECT {SALES_SQL} FROM mod_venda")
def measures_sales(m):
    return evaluate(m.star, SALES, context=CTX)


@query("measures_sales_by_channel", "canal_venda:s " + SALES_TYPES, f"SELECT canal_venda, {SALES_SQL} FROM mod_venda GROUP BY ALL")
def measures_sales_by_channel(m):
    return evaluate(m.star, SALES, ["canal_venda"], context=CTX)


@query(
    "measures_sales_by_region",
    "regiao:s ano:l receita_liquida:d ticket_medio:d margem_bruta_pct:d",
    f"""SELECT l.regiao, CASE WHEN sk_tempo > 0 THEN year(dt_pedido_data) END AS ano, sum(valor_liquido_item) AS receita_liquida,
        {div('sum(valor_liquido_item)', 'count(DISTINCT id_pedido_dg)')} AS ticket_medio,
        {div('sum(margem_bruta_item)', 'sum(valor_liquido_item)')} AS margem_bruta_pct
        FROM mod_venda LEFT JOIN src_rh__lojas l USING (id_loja) GROUP BY ALL""",
)
def measures_sales_by_region(m):
    """Filter context over two dimensions; unknown members form their own group."""
    return evaluate(m.star, ["receita_liquida", "ticket_medio", "margem_bruta_pct"], ["dim_loja.regiao", "dim_tempo.ano"])


@query(
    "measure_mix",
    "canal_venda:s receita_liquida:d mix_pct:d",
    """SELECT canal_venda, receita AS receita_liquida, CAST(receita AS DOUBLE) / CAST(sum(receita) OVER () AS DOUBLE) AS mix_pct
       FROM (SELECT canal_venda, sum(valor_liquido_item) AS receita FROM mod_venda GROUP BY ALL) t""",
)
def measure_mix(m):
    return ms.mix(m.star, "canal_venda")


@query(
    "measure_budget",
    "canal_venda:s atingimento_meta:d budget_receita:d realizado_receita:d variacao_receita_soma:d variacao_receita_pct:d",
    f"""SELECT canal_venda, {div('sum(receita_realizada)', 'sum(valor_meta_receita)')} AS atingimento_meta,
        sum(valor_meta_receita) AS budget_receita, sum(receita_realizada) AS realizado_receita,
        floor(sum(var_receita_pct) * 100.0 + 0.5) / 100.0 AS variacao_receita_soma,
        {div('sum(receita_realizada) - sum(valor_meta_receita)', 'sum(valor_meta_receita)')} AS variacao_receita_pct
        FROM mod_orcamento GROUP BY ALL""",
)
def measure_budget(m):
    names = ["atingimento_meta", "budget_receita", "realizado_receita", "variacao_receita_soma", "variacao_receita_pct"]
    rows = evaluate(m.star, names, ["canal_venda"])
    # A sum of doubles depends on their order in the last digits.
    return rows.withColumn("variacao_receita_soma", round_ratio(F.col("variacao_receita_soma"), 2))


@query(
    "measure_period_shift",
    "periodo:s receita_liquida:d ano_anterior:d mes_anterior:d",
    """WITH mensal AS (SELECT date_trunc('month', dt_pedido_data)::DATE AS periodo, sum(valor_liquido_item) AS receita
                       FROM mod_venda GROUP BY ALL)
       SELECT a.periodo, a.receita AS receita_liquida, y.receita AS ano_anterior, p.receita AS mes_anterior FROM mensal a
       LEFT JOIN mensal y ON y.periodo = a.periodo - INTERVAL 1 YEAR LEFT JOIN mensal p ON p.periodo = a.periodo - INTERVAL 1 MONTH""",
)
def measure_period_shift(m):
    return ms.year_over_year(m.star)


@query(
    "measure_week_shift",
    "periodo:s receita_liquida:d semana_anterior:d",
    """WITH diario AS (SELECT dt_pedido_data AS periodo, sum(valor_liquido_item) AS receita FROM mod_venda GROUP BY ALL)
       SELECT a.periodo, a.receita AS receita_liquida, b.receita AS semana_anterior FROM diario a
       LEFT JOIN diario b ON b.periodo + 7 = a.periodo""",
)
def measure_week_shift(m):
    return ms.week_over_week(m.star)


@query(
    "measure_rank",
    "nome_loja:s receita_liquida:d rank_loja:l",
    """SELECT nome_loja, receita_liquida, dense_rank() OVER (ORDER BY receita_liquida DESC) AS rank_loja
       FROM (SELECT nome_loja, sum(valor_liquido_item) AS receita_liquida FROM mod_venda
             LEFT JOIN src_rh__lojas USING (id_loja) GROUP BY ALL) t""",
)
def measure_rank(m):
    return ms.store_ranking(m.star)


@query(
    "measures_customers",
    "segmento_rfm:s clientes:l ltv_medio:d saldo_pontos:l novos_clientes:l",
    f"""SELECT segmento_rfm, count(*) AS clientes, {div('sum(ltv)', 'count(*)')} AS ltv_medio,
        sum(saldo_techpoints) AS saldo_pontos,
        count(*) FILTER (primeira_compra BETWEEN DATE '1995-03-01' AND DATE '1995-06-30') AS novos_clientes
        FROM mod_dim_cliente GROUP BY ALL""",
)
def measures_customers(m):
    names = ["clientes", "ltv_medio", "saldo_pontos", "novos_clientes"]
    return evaluate(m.star, names, ["dim_cliente.segmento_rfm"], context=CTX)


@query(
    "measures_cart",
    "canal_origem:s sessoes:l taxa_conversao:d taxa_abandono_carrinho:d",
    f"""SELECT canal_origem, count(*) AS sessoes, {div('count(*) FILTER (converteu)', 'count(*)')} AS taxa_conversao,
        {div('count(*) FILTER (fl_abandono_carrinho)', 'count(*) FILTER (qtd_add_cart > 0)')} AS taxa_abandono_carrinho
        FROM mod_sessao GROUP BY ALL""",
)
def measures_cart(m):
    return evaluate(m.star, ["sessoes", "taxa_conversao", "taxa_abandono_carrinho"], ["canal_origem"])


STOCK_SQL = f"""
    SELECT coalesce(v.k, e.k) AS sk_produto, {div('vendidas', 'estoque')} AS giro_estoque,
        {div('vendidas_30d', '30')} AS venda_media_diaria_30d, {div('ultimo', div('vendidas_30d', '30'))} AS dias_cobertura,
        taxa_ruptura, margem_produto_pct
    FROM (SELECT sk_produto AS k, sum(qtd_vendida) AS vendidas,
            sum(qtd_vendida) FILTER (dt_pedido_data BETWEEN DATE '2001-07-02' AND DATE '2001-07-31') AS vendidas_30d,
            {div('sum(margem_bruta_item)', 'sum(valor_liquido_item)')} AS margem_produto_pct FROM mod_venda GROUP BY ALL) v
    FULL JOIN (SELECT sk_produto AS k, {div('sum(qtd_disponivel)', 'count(*)')} AS estoque,
            arg_max(qtd_disponivel, sk_tempo::BIGINT * 1000 + qtd_disponivel) AS ultimo,
            {div('max(CASE WHEN fl_ruptura THEN 1 ELSE 0 END)', '1')} AS taxa_ruptura FROM mod_estoque GROUP BY ALL) e
      ON v.k = e.k"""


@query(
    "measures_stock",
    "sk_produto:s giro_estoque:d venda_media_diaria_30d:d dias_cobertura:d taxa_ruptura:d margem_produto_pct:d",
    STOCK_SQL,
)
def measures_stock(m):
    """Measures over two facts, lined up per product."""
    names = ["giro_estoque", "venda_media_diaria_30d", "dias_cobertura", "taxa_ruptura", "margem_produto_pct"]
    return evaluate(m.star, names, ["sk_produto"], context=CTX)


@query(
    "measures_logistics",
    "canal_venda:s otd_pct:d otd_entregues_pct:d lead_time_medio:d atraso_medio:d pedidos_abertos:l",
    f"""SELECT canal_venda, {div('count(*) FILTER (fl_sla_atendido)', 'count(*)')} AS otd_pct,
        {div('count(*) FILTER (fl_sla_atendido)', 'count(*) FILTER (fl_entregue)')} AS otd_entregues_pct,
        {div('sum(lead_time_real_dias)', 'count(lead_time_real_dias)')} AS lead_time_medio,
        {div('sum(atraso_dias) FILTER (NOT fl_sla_atendido)', 'count(atraso_dias) FILTER (NOT fl_sla_atendido)')} AS atraso_medio,
        count(*) FILTER (NOT fl_entregue) AS pedidos_abertos FROM mod_entrega GROUP BY ALL""",
)
def measures_logistics(m):
    names = ["otd_pct", "otd_entregues_pct", "lead_time_medio", "atraso_medio", "pedidos_abertos"]
    return evaluate(m.star, names, ["canal_venda"])


@query(
    "measure_freight_by_order",
    "canal_venda:s frete_pct_receita_pedido:d",
    f"""SELECT canal_venda, {div('sum(frete)', 'sum(receita)')} AS frete_pct_receita_pedido
        FROM (SELECT canal_venda, id_pedido_dg, any_value(valor_frete_pedido) AS frete, sum(valor_liquido_item) AS receita
              FROM mod_venda GROUP BY ALL) t GROUP BY ALL""",
)
def measure_freight_by_order(m):
    return ms.freight_share_by_order(m.star, ["canal_venda"])


@query(
    "measures_finance",
    "sk_loja:s receita_bruta_ff:d cr_vencer:d cr_vencido:d valor_lancado:d",
    """SELECT sk_loja, sum(valor) FILTER (tipo = 'receita') AS receita_bruta_ff,
        sum(valor) FILTER (NOT fl_pago AND dt_pagamento >= DATE '2001-07-31') AS cr_vencer,
        sum(valor) FILTER (NOT fl_pago AND dt_pagamento < DATE '2001-07-31') AS cr_vencido, sum(valor) AS valor_lancado
       FROM mod_financeiro GROUP BY ALL""",
)
def measures_finance(m):
    return evaluate(m.star, ["receita_bruta_ff", "cr_vencer", "cr_vencido", "valor_lancado"], ["sk_loja"], context=CTX)


@query(
    "measure_accrual",
    "papel:s periodo:s valor_lancado:d",
    """SELECT 'competencia' AS papel, date_trunc('month', dt_competencia)::DATE AS periodo, sum(valor) AS valor_lancado
       FROM mod_financeiro GROUP BY ALL
       UNION ALL SELECT 'lancamento', date_trunc('month', dt_lancamento)::DATE, sum(valor) FROM mod_financeiro GROUP BY ALL""",
)
def measure_accrual(m):
    """The ledger by accrual month and by entry month: two roles of one calendar."""
    accrual = ms.ledger_by_month(m.star).withColumn("papel", F.lit("competencia"))
    entry = ms.ledger_by_month(m.star, "dt_lancamento").withColumn("papel", F.lit("lancamento"))
    return accrual.unionByName(entry)


@query(
    "measures_campaign",
    "receita_atribuida:d receita_atribuida_literal:d investimento_campanha:d roi_campanha:d",
    f"""SELECT r.*, o.*, {div('receita_atribuida - investimento_campanha', 'investimento_campanha')} AS roi_campanha
        FROM (SELECT sum(valor_liquido_item) FILTER (sk_campanha <> 'SEM_CAMPANHA') AS receita_atribuida,
                sum(valor_liquido_item) AS receita_atribuida_literal FROM mod_venda) r,
             (SELECT sum(orcamento) AS investimento_campanha FROM src_marketing__campanhas) o""",
)
def measures_campaign(m):
    names = ["receita_atribuida", "receita_atribuida_literal", "investimento_campanha", "roi_campanha"]
    return evaluate(m.star, names)
