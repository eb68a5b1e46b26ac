"""Dashboard reports over the star."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from catalog.models import div
from catalog.registry import query
from emporio.functions.numeric import round_ratio
from emporio.plans import dashboards as db

AS_OF = date(2001, 7, 31)
VALID = "(SELECT * FROM mod_venda WHERE fl_venda_valida)"
MONTH = "date_trunc('month', {0})::DATE"


@query(
    "retention",
    "mes:s ativos:l recorrentes:l base_anterior:l taxa_retencao:d",
    f"""WITH ativo AS (SELECT DISTINCT sk_cliente, {MONTH.format('dt_pedido_data')} AS mes FROM {VALID} v),
        mensal AS (SELECT a.mes, count(*) AS ativos, count(b.mes) AS recorrentes FROM ativo a
                   LEFT JOIN ativo b ON b.sk_cliente = a.sk_cliente AND b.mes = a.mes - INTERVAL 1 MONTH GROUP BY ALL)
        SELECT m.*, p.ativos AS base_anterior, {div('m.recorrentes', 'p.ativos')} AS taxa_retencao
        FROM mensal m LEFT JOIN mensal p ON p.mes = m.mes - INTERVAL 1 MONTH""",
)
def retention(m):
    return db.retention(m.star)


@query(
    "churn",
    "base_anterior:l inativos:l churn_rate:d",
    f"""SELECT *, {div('inativos', 'base_anterior')} AS churn_rate FROM (
        SELECT count(*) FILTER (primeira < DATE '2001-05-02') AS base_anterior,
          count(*) FILTER (ultima < DATE '2001-05-02') AS inativos
        FROM (SELECT sk_cliente, min(dt_pedido_data) AS primeira, max(dt_pedido_data) AS ultima FROM {VALID} v
              WHERE dt_pedido_data <= DATE '2001-07-31' GROUP BY ALL) c) t""",
)
def churn(m):
    return db.churn(m.star, AS_OF)


@query(
    "cohort_retention",
    "cohort:s offset:l active:l base:l retencao:d",
    f"""WITH ativo AS (SELECT DISTINCT sk_cliente, {MONTH.format('dt_pedido_data')} AS mes FROM {VALID} v),
        inicio AS (SELECT sk_cliente, min(mes) AS cohort FROM ativo GROUP BY ALL),
        curva AS (SELECT cohort, date_diff('month', cohort, mes) AS "offset", count(*) AS active
                  FROM ativo JOIN inicio USING (sk_cliente) GROUP BY ALL)
        SELECT *, CAST(active AS DOUBLE) / base AS retencao FROM (
          SELECT *, first_value(active) OVER (PARTITION BY cohort ORDER BY "offset") AS base FROM curva) c""",
)
def cohort_retention(m):
    return db.cohort_retention(m.star)


@query(
    "omnichannel",
    "sk_cliente:s",
    f"""SELECT sk_cliente FROM {VALID} v WHERE year(dt_pedido_data) = 1997
        GROUP BY sk_cliente HAVING count(DISTINCT fl_online) = 2""",
)
def omnichannel(m):
    return db.omnichannel_customers(m.star, date(1997, 1, 1), date(1998, 1, 1))


@query(
    "ticket_by_segment",
    "nivel_fidelidade:s segmento_rfm:s ticket_medio:d total_pedidos:l",
    f"""SELECT nivel_fidelidade, segmento_rfm, {div('sum(valor_liquido_item)', 'count(DISTINCT id_pedido_dg)')} AS ticket_medio,
        count(DISTINCT id_pedido_dg) AS total_pedidos
        FROM mod_venda v LEFT JOIN mod_dim_cliente c ON c.sk_cliente = v.sk_cliente GROUP BY ALL""",
)
def ticket_by_segment(m):
    return db.ticket_by_segment(m.star)


@query(
    "no_sales_products",
    "id_produto_nk:l ultima_venda:s sem_giro_30d:b sem_giro_60d:b sem_giro_90d:b",
    f"""SELECT p.id_produto AS id_produto_nk, ultima_venda,
        NOT EXISTS (FROM {VALID} v WHERE v.id_produto = p.id_produto AND dt_pedido_data > DATE '2001-07-01' AND dt_pedido_data <= DATE '2001-07-31') AS sem_giro_30d,
        NOT EXISTS (FROM {VALID} v WHERE v.id_produto = p.id_produto AND dt_pedido_data > DATE '2001-06-01' AND dt_pedido_data <= DATE '2001-07-31') AS sem_giro_60d,
        NOT EXISTS (FROM {VALID} v WHERE v.id_produto = p.id_produto AND dt_pedido_data > DATE '2001-05-02' AND dt_pedido_data <= DATE '2001-07-31') AS sem_giro_90d
        FROM src_produtos__produtos p
        LEFT JOIN (SELECT id_produto, max(dt_pedido_data) AS ultima_venda FROM {VALID} v
                   WHERE dt_pedido_data <= DATE '2001-07-31' GROUP BY ALL) u USING (id_produto)""",
)
def no_sales_products(m):
    return db.products_without_sales(m.star, AS_OF)


TOTALS_SQL = f"""(SELECT id_produto AS id_produto_nk, sum(valor_liquido_item) AS receita, sum(margem_bruta_item) AS margem,
    sum(qtd_vendida) AS unidades FROM {VALID} v WHERE sk_produto <> 'DESCONHECIDO' GROUP BY ALL)"""


@query(
    "abc_curve",
    "id_produto_nk:l receita:d cum_share:d classe:s",
    f"""SELECT *, CASE WHEN cum_share <= 0.80 THEN 'A' WHEN cum_share <= 0.95 THEN 'B' ELSE 'C' END AS classe FROM (
        SELECT id_produto_nk, receita, CAST(sum(receita) OVER (ORDER BY receita DESC, id_produto_nk
          ROWS UNBOUNDED PRECEDING) AS DOUBLE) / CAST(sum(receita) OVER () AS DOUBLE) AS cum_share FROM {TOTALS_SQL} t) c""",
)
def abc_curve(m):
    return db.abc_curve(m.star)


@query(
    "topn_products",
    "id_produto_nk:l receita:d margem:d unidades:l",
    f"SELECT * FROM {TOTALS_SQL} t ORDER BY receita DESC, id_produto_nk LIMIT 20",
)
def topn_products(m):
    return db.top_products(m.star, 20)


@query(
    "category_performers",
    "categoria:s id_produto_nk:l pontuacao:d",
    f"""SELECT categoria, id_produto_nk, CAST(margem AS DOUBLE) * CAST(unidades AS DOUBLE) AS pontuacao FROM {TOTALS_SQL} t
        JOIN mod_catalogo c ON c.id_produto = id_produto_nk
        QUALIFY row_number() OVER (PARTITION BY categoria ORDER BY CAST(margem AS DOUBLE) * CAST(unidades AS DOUBLE) DESC,
          id_produto_nk) <= 5""",
)
def category_performers(m):
    return db.category_performers(m.star, 5)


@query(
    "return_rate_by_product",
    "sk_produto:s taxa_devolucao:d total_pedidos:l",
    f"""SELECT sk_produto, {div('count(DISTINCT id_pedido_dg) FILTER (fl_devolvido)', 'count(DISTINCT id_pedido_dg)')} AS taxa_devolucao,
        count(DISTINCT id_pedido_dg) AS total_pedidos FROM mod_venda GROUP BY ALL""",
)
def return_rate_by_product(m):
    return db.return_rate_by_product(m.star)


@query(
    "brand_mix",
    "categoria:s marca:s receita_liquida_valida:d participacao:d",
    f"""SELECT *, CAST(receita_liquida_valida AS DOUBLE) / CAST(sum(receita_liquida_valida) OVER (PARTITION BY categoria) AS DOUBLE)
          AS participacao
        FROM (SELECT categoria, marca, sum(valor_liquido_item) AS receita_liquida_valida FROM {VALID} v
              JOIN mod_catalogo c ON c.id_produto = v.id_produto GROUP BY ALL) t""",
)
def brand_mix(m):
    return db.brand_mix(m.star)


@query(
    "stock_cover",
    "id_produto_nk:l id_loja_nk:l dt_ultima_atualizacao:s qtd_disponivel:l saida_janela:l dias_cobertura:d giro:d",
    f"""SELECT *, {div('qtd_disponivel * 30', 'saida_janela')} AS dias_cobertura,
        {div('saida_janela', div('estoque', 'dias'))} AS giro
        FROM (SELECT *, sum(qtd_saida_dia) OVER j AS saida_janela, sum(qtd_disponivel) OVER j AS estoque, count(*) OVER j AS dias
              FROM mod_estoque WINDOW j AS (PARTITION BY id_produto_nk, id_loja_nk ORDER BY dt_ultima_atualizacao
                RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW)) t""",
)
def stock_cover(m):
    return db.stock_cover(m.star)


@query(
    "stock_value",
    "sk_estoque:s qtd_total:l valor_estoque:d",
    """SELECT sk_estoque, qtd_total, qtd_total * custo_vigente AS valor_estoque FROM mod_estoque
       LEFT JOIN mod_catalogo ON id_produto = id_produto_nk""",
)
def stock_value(m):
    return db.stock_value(m.star)


@query(
    "sla_by_carrier",
    "nome:s mes:s otd_pct:d lead_time_medio:d pedidos_abertos:l",
    f"""SELECT transportadora AS nome, {MONTH.format('dt_postagem')} AS mes,
        {div('count(*) FILTER (fl_sla_atendido)', 'count(*)')} AS otd_pct,
        {div('sum(lead_time_real_dias)', 'count(lead_time_real_dias)')} AS lead_time_medio,
        count(*) FILTER (NOT fl_entregue) AS pedidos_abertos FROM mod_entrega GROUP BY ALL""",
)
def sla_by_carrier(m):
    return db.sla_by_carrier(m.star)


@query(
    "ship_from_store",
    "canal_venda:s entregas:l ship_from_store:d ship_from_cd:d",
    f"""SELECT canal_venda, count(*) AS entregas, {div("count(*) FILTER (tipo_loja = 'fisica')", 'count(*)')} AS ship_from_store,
        {div("count(*) FILTER (tipo_loja = 'cd')", 'count(*)')} AS ship_from_cd FROM mod_entrega GROUP BY ALL""",
)
def ship_from_store(m):
    return db.ship_from_store(m.star)


@query(
    "aging_buckets",
    "faixa:s pedidos:l",
    """SELECT CASE WHEN d < 0 THEN 'a_vencer' WHEN d <= 7 THEN '0-7' WHEN d <= 15 THEN '8-15' WHEN d <= 30 THEN '16-30'
         WHEN d <= 60 THEN '31-60' ELSE '>60' END AS faixa, count(*) AS pedidos
       FROM (SELECT date_diff('day', dt_postagem, DATE '2001-07-31') AS d FROM mod_entrega WHERE NOT fl_entregue) t
       WHERE d IS NOT NULL GROUP BY ALL""",
)
def aging_buckets(m):
    return db.open_order_aging(m.star, AS_OF)


@query(
    "receivable_aging",
    "faixa:s titulos:l valor_aberto:d",
    """SELECT CASE WHEN d < 0 THEN 'a_vencer' WHEN d <= 30 THEN '0-30' WHEN d <= 60 THEN '31-60' WHEN d <= 90 THEN '61-90'
         ELSE '>90' END AS faixa, count(*) AS titulos, sum(v) AS valor_aberto
       FROM (SELECT date_diff('day', dt_vencimento, DATE '2001-07-31') AS d, valor_original - valor_pago AS v
             FROM src_financeiro__contas_receber WHERE status <> 'pago') t GROUP BY ALL""",
)
def receivable_aging(m):
    return db.receivable_aging(m["stg_financeiro__contas_receber"], AS_OF)


@query(
    "pnl_month",
    "mes:s canal_venda:s receita_liquida:d cmv:d margem_bruta:d margem_pct:d receita_mes_anterior:d var_mom:d",
    f"""WITH mensal AS (SELECT {MONTH.format('dt_pedido_data')} AS mes, canal_venda, sum(valor_liquido_item) AS receita_liquida,
          sum(qtd_vendida * custo_unitario) AS cmv, sum(margem_bruta_item) AS margem_bruta FROM {VALID} v GROUP BY ALL)
        SELECT a.*, b.receita_liquida AS receita_mes_anterior, {div('a.margem_bruta', 'a.receita_liquida')} AS margem_pct,
          {div('a.receita_liquida', 'b.receita_liquida')} - 1 AS var_mom
        FROM mensal a LEFT JOIN mensal b ON b.canal_venda = a.canal_venda AND b.mes + INTERVAL 1 MONTH = a.mes""",
)
def pnl_month(m):
    return db.profit_and_loss(m.star)


@query(
    "instalments",
    "parcelado:b lancamentos:l valor_total:d prazo_medio:d pct_lancamentos:d pct_valor:d",
    f"""SELECT parcelas > 1 AS parcelado, count(*) AS lancamentos, sum(valor) AS valor_total, {div('sum(parcelas)', 'count(*)')} AS prazo_medio,
        CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS pct_lancamentos,
        CAST(sum(valor) AS DOUBLE) / CAST(sum(sum(valor)) OVER () AS DOUBLE) AS pct_valor
        FROM (SELECT id_lancamento, max(numero_parcela) AS parcelas, sum(valor_parcela) AS valor
              FROM src_financeiro__parcelas GROUP BY ALL) t GROUP BY ALL""",
)
def instalments(m):
    return db.instalments(m["stg_financeiro__parcelas"])


@query(
    "loyalty_points",
    "mes:s nivel_fidelidade:s pontos_emitidos:l pontos_resgatados:l saldo_pontos:l",
    f"""SELECT {MONTH.format('updated_at')} AS mes, nivel_fidelidade, sum(pontos_acumulados) AS pontos_emitidos,
        sum(pontos_resgatados) AS pontos_resgatados, sum(saldo_pontos) AS saldo_pontos
        FROM src_clientes__techpoints GROUP BY ALL""",
)
def loyalty_points(m):
    return db.loyalty_programme(m["stg_clientes__techpoints"])


@query(
    "campaign_returns",
    "sk_campanha:s receita_atribuida:d investimento_campanha:d roi_campanha:d roas:d",
    f"""SELECT md5(CAST(c.id_campanha AS VARCHAR)) AS sk_campanha, receita AS receita_atribuida, orcamento AS investimento_campanha,
        {div('coalesce(receita, 0) - orcamento', 'orcamento')} AS roi_campanha, {div('coalesce(receita, 0)', 'orcamento')} AS roas
        FROM src_marketing__campanhas c
        LEFT JOIN (SELECT sk_campanha, sum(valor_liquido_item) AS receita FROM mod_venda GROUP BY ALL) v
          ON v.sk_campanha = md5(CAST(c.id_campanha AS VARCHAR))""",
)
def campaign_returns(m):
    return db.campaign_returns(m.star)


@query(
    "acquisition_cost",
    "mes:s investimento:d novos_clientes:l cac:d",
    f"""SELECT coalesce(g.mes, n.mes) AS mes, investimento, novos_clientes, {div('investimento', 'novos_clientes')} AS cac
        FROM (SELECT {MONTH.format('dt_inicio')} AS mes, sum(orcamento) AS investimento FROM src_marketing__campanhas GROUP BY ALL) g
        FULL JOIN (SELECT {MONTH.format('primeira_compra')} AS mes, count(*) AS novos_clientes FROM mod_clientes
                   WHERE primeira_compra IS NOT NULL GROUP BY ALL) n ON g.mes = n.mes""",
)
def acquisition_cost(m):
    return db.acquisition_cost(m.star)


@query(
    "funnel",
    "canal_origem:s sessoes:l com_carrinho:l convertidas:l taxa_conversao:d",
    f"""SELECT canal_origem, count(*) AS sessoes, count(*) FILTER (qtd_add_cart > 0) AS com_carrinho,
        count(*) FILTER (converteu) AS convertidas, {div('count(*) FILTER (converteu)', 'count(*)')} AS taxa_conversao
        FROM mod_sessao GROUP BY ALL""",
)
def funnel(m):
    return db.funnel(m.star)


@query(
    "reactivated_customers",
    "sk_campanha:s reativados:l",
    f"""SELECT md5(CAST(id_campanha AS VARCHAR)) AS sk_campanha, count(DISTINCT sk_cliente) AS reativados
        FROM (SELECT sk_cliente, dia, date_diff('day', lag(dia) OVER (PARTITION BY sk_cliente ORDER BY dia), dia) AS pausa
              FROM (SELECT DISTINCT sk_cliente, dt_pedido_data AS dia FROM {VALID} v) d) t
        JOIN src_marketing__campanhas ON dia BETWEEN dt_inicio AND dt_fim WHERE pausa > 90 GROUP BY ALL""",
)
def reactivated_customers(m):
    return db.reactivated_customers(m.star)


@query(
    "weighted_attribution",
    "id_campanha:l receita_atribuida:d pedidos:l",
    f"""SELECT id_campanha, sum(receita * peso) AS receita_atribuida, count(*) AS pedidos FROM src_marketing__atribuicao
        JOIN (SELECT id_pedido_dg, sum(valor_liquido_item) AS receita FROM {VALID} v GROUP BY ALL) r ON id_pedido_dg = id_pedido
        GROUP BY ALL""",
)
def weighted_attribution(m):
    return db.weighted_attribution(m.star, m["stg_marketing__atribuicao"])


@query(
    "attribution_models",
    "modelo:s canal:s valor:d",
    """WITH t AS (SELECT *, count(*) OVER c AS n, sum(valor_liquido) OVER c AS total,
                    row_number() OVER (PARTITION BY id_cliente ORDER BY dt_pedido, id_pedido) AS k
                  FROM src_vendas__pedidos WINDOW c AS (PARTITION BY id_cliente))
       SELECT 'first_touch' AS modelo, canal_venda AS canal, sum(total) AS valor FROM t WHERE k = 1 GROUP BY ALL
       UNION ALL SELECT 'last_touch', canal_venda, sum(total) FROM t WHERE k = n GROUP BY ALL
       UNION ALL SELECT 'linear', canal_venda, floor(sum(CAST(total AS DOUBLE) / n) * 10.0 + 0.5) / 10.0 FROM t GROUP BY ALL""",
)
def attribution_models(m):
    """Each customer's revenue credited to order channels under the three models."""
    rows = db.attribution_models(
        m["stg_vendas__pedidos"], "id_cliente", "dt_pedido", "canal_venda", "valor_liquido", "id_pedido"
    )
    # The linear model adds fractions, whose order shows in the last digits.
    return rows.withColumn("valor", F.when(F.col("modelo") == "linear", round_ratio(F.col("valor"), 1)).otherwise(F.col("valor")))


@query(
    "seller_vs_target",
    "id_vendedor:l ano:l mes:l receita:d pedidos:l meta_valor:d meta_pedidos:l nome:s nome_loja:s atingimento:d",
    f"""SELECT *, {div('receita', 'meta_valor')} AS atingimento FROM
        (SELECT id_vendedor, ano, mes, sum(meta_valor) AS meta_valor, sum(meta_qtd_pedidos) AS meta_pedidos FROM src_rh__metas GROUP BY ALL) g
        FULL JOIN (SELECT id_vendedor, year(dt_competencia) AS ano, month(dt_competencia) AS mes, sum(valor_venda) AS receita,
                     count(DISTINCT id_pedido) AS pedidos FROM src_rh__comissoes GROUP BY ALL) c USING (id_vendedor, ano, mes)
        LEFT JOIN (SELECT v.id_vendedor, v.nome, l.nome_loja FROM src_rh__vendedores v LEFT JOIN src_rh__lojas l USING (id_loja)) n
          USING (id_vendedor)""",
)
def seller_vs_target(m):
    return db.seller_performance(m.star, m["stg_rh__comissoes"], m["stg_rh__metas"])
