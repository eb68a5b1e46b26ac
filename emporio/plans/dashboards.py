"""Dashboard reports over the star and the staged tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporio.functions.calendar import month_start
from emporio.functions.numeric import safe_divide
from emporio.operators.joins import having_any, interval_join
from emporio.operators.periods import cohort, period_shifts, rolling_sums
from emporio.operators.ranking import cumulative_share, share_of_total, top_n, top_n_per_group
from emporio.plans.measures import evaluate, mean
from emporio.plans.star import Star

_c = F.col


def _valid(star: Star) -> DataFrame:
    return star["fato_venda"].filter("fl_venda_valida")


# -- customers ---------------------------------------------------------------


def monthly_activity(sales: DataFrame) -> DataFrame:
    """One row per customer and month with a purchase."""
    return sales.select("sk_cliente", month_start(_c("dt_pedido_data")).alias("mes")).distinct()


def retention(star: Star) -> DataFrame:
    """Per month: active customers, those active the month before too, and both rates.

    Retention is returning over the previous month's base.
    """
    active = monthly_activity(_valid(star))
    # One row per customer and month, so a customer's window is as short as the calendar.
    before = F.lag("mes").over(Window.partitionBy("sk_cliente").orderBy("mes"))
    returning = before == F.add_months("mes", -1)
    months = active.select("mes", returning.alias("voltou")).groupBy("mes").agg(
        F.count(F.lit(1)).alias("ativos"), F.count_if(_c("voltou")).alias("recorrentes")
    )
    with_base = period_shifts(months, "mes", "ativos", {"base_anterior": (1, 0)})
    return with_base.withColumn("taxa_retencao", safe_divide(_c("recorrentes"), _c("base_anterior")))


def churn(star: Star, as_of: date, days: int = 90) -> DataFrame:
    """Customers who bought before the last ``days`` days and not since, over all who had bought before."""
    cut = F.lit(as_of - timedelta(days=days))
    per_customer = _valid(star).filter(_c("dt_pedido_data") <= F.lit(as_of)).groupBy("sk_cliente").agg(
        F.min("dt_pedido_data").alias("primeira"), F.max("dt_pedido_data").alias("ultima")
    )
    base = _c("primeira") < cut
    return per_customer.agg(
        F.count_if(base).alias("base_anterior"), F.count_if(base & (_c("ultima") < cut)).alias("inativos")
    ).withColumn("churn_rate", safe_divide(_c("inativos"), _c("base_anterior")))


def cohort_retention(star: Star) -> DataFrame:
    """Share of each acquisition month still buying n months later."""
    counts = cohort(_valid(star), "sk_cliente", "dt_pedido_data")
    return counts.withColumn("retencao", safe_divide(_c("active"), _c("base")))


def omnichannel_customers(star: Star, start: date, end: date) -> DataFrame:
    """Customers with a physical and an online purchase in ``[start, end)``."""
    window = _valid(star).filter((_c("dt_pedido_data") >= F.lit(start)) & (_c("dt_pedido_data") < F.lit(end)))
    return having_any(window, "sk_cliente", ~_c("fl_online"), _c("fl_online"))


def ticket_by_segment(star: Star) -> DataFrame:
    """Average ticket per loyalty level and segment."""
    return evaluate(
        star, ["ticket_medio", "total_pedidos"], ["dim_cliente.nivel_fidelidade", "dim_cliente.segmento_rfm"]
    )


def loyalty_programme(points: DataFrame, months: bool = True) -> DataFrame:
    """Points issued, redeemed and held per level, and per month of the last change."""
    groups: list[Column] = [_c("nivel_fidelidade")]
    if months:
        groups.insert(0, month_start(_c("updated_at")).alias("mes"))
    return points.groupBy(*groups).agg(
        F.sum("pontos_acumulados").alias("pontos_emitidos"),
        F.sum("pontos_resgatados").alias("pontos_resgatados"),
        F.sum("saldo_pontos").alias("saldo_pontos"),
    )


# -- products ----------------------------------------------------------------


def products_without_sales(star: Star, as_of: date, windows: Sequence[int] = (30, 60, 90)) -> DataFrame:
    """Products with their last sale and one flag per window without a sale (E5).

    One aggregate for all windows; a product never sold is idle in each.
    """
    last = (
        _valid(star)
        .filter(_c("dt_pedido_data") <= F.lit(as_of))
        .groupBy("sk_produto")
        .agg(F.max("dt_pedido_data").alias("ultima_venda"))
    )
    products = star["dim_produto"].filter("fl_current").select("sk_produto", "id_produto_nk")
    return products.join(last, "sk_produto", "left").select(
        "sk_produto",
        "id_produto_nk",
        "ultima_venda",
        *[
            F.coalesce(_c("ultima_venda") <= F.lit(as_of - timedelta(days=d)), F.lit(True)).alias(f"sem_giro_{d}d")
            for d in windows
        ],
    )


def product_totals(star: Star) -> DataFrame:
    """Revenue, margin and units of valid sales per product."""
    return _valid(star).groupBy("sk_produto").agg(
        F.sum("valor_liquido_item").alias("receita"),
        F.sum("margem_bruta_item").alias("margem"),
        F.sum("qtd_vendida").alias("unidades"),
    ).join(star["dim_produto"].filter("fl_current").select("sk_produto", "id_produto_nk"), "sk_produto")


# Cumulative revenue share up to which a product is class A, then B.
ABC_CUTS = ((0.80, "A"), (0.95, "B"))


def abc_curve(star: Star, value: str = "receita", **options) -> DataFrame:
    """Cumulative share and class per product, largest first."""
    curve = cumulative_share(product_totals(star), value, "id_produto_nk", **options)
    share = _c("cum_share")
    (a, class_a), (b, class_b) = ABC_CUTS
    return curve.withColumn("classe", F.when(share <= a, class_a).when(share <= b, class_b).otherwise("C"))


def top_products(star: Star, n: int = 20, worst: bool = False) -> DataFrame:
    """Best or worst products by revenue."""
    order = F.asc("receita") if worst else F.desc("receita")
    return top_n(product_totals(star), [order, F.asc("id_produto_nk")], n)


def category_performers(star: Star, n: int = 5, worst: bool = False) -> DataFrame:
    """Best or worst products of each category by margin times volume."""
    categories = star["dim_produto"].filter("fl_current").select("sk_produto", "categoria")
    scored = product_totals(star).join(categories, "sk_produto").withColumn(
        "pontuacao", _c("margem").cast("double") * _c("unidades")
    )
    order = F.asc("pontuacao") if worst else F.desc("pontuacao")
    return top_n_per_group(scored, ["categoria"], [order, F.asc("id_produto_nk")], n)


def return_rate_by_product(star: Star) -> DataFrame:
    """Distinct returned orders over distinct orders, per product."""
    return evaluate(star, ["taxa_devolucao", "total_pedidos"], ["sk_produto"])


def brand_mix(star: Star) -> DataFrame:
    """Revenue share of each brand within its category."""
    revenue = evaluate(star, ["receita_liquida_valida"], ["dim_produto.categoria", "dim_produto.marca"])
    known = revenue.filter(_c("receita_liquida_valida").isNotNull() & _c("categoria").isNotNull())
    return share_of_total(known, "receita_liquida_valida", "participacao", within=["categoria"])


def stock_cover(star: Star, days: int = 30) -> DataFrame:
    """Cover and turnover per product, store and snapshot day.

    Sales are the stock outflow of the day; both sides use the trailing window.
    """
    keys = ["id_produto_nk", "id_loja_nk"]
    day = "dt_ultima_atualizacao"
    rows = rolling_sums(
        star["fato_estoque"],
        day,
        {"saida_janela": _c("qtd_saida_dia"), "estoque_janela": _c("qtd_disponivel"), "dias_observados": F.lit(1)},
        days,
        keys,
    )
    mean_stock = safe_divide(_c("estoque_janela"), _c("dias_observados"))
    return rows.select(
        *keys,
        day,
        "qtd_disponivel",
        "saida_janela",
        safe_divide(_c("qtd_disponivel") * days, _c("saida_janela")).alias("dias_cobertura"),
        safe_divide(_c("saida_janela"), mean_stock).alias("giro"),
    )


def stock_value(star: Star) -> DataFrame:
    """Quantity held times current unit cost, per snapshot row."""
    costs = star["dim_produto"].filter("fl_current").select("sk_produto", "custo_vigente")
    return star["fato_estoque"].join(costs, "sk_produto", "left").select(
        "sk_estoque", "id_produto_nk", "id_loja_nk", "dt_ultima_atualizacao", "qtd_total",
        (_c("qtd_total") * _c("custo_vigente")).alias("valor_estoque"),
    )


# -- logistics ---------------------------------------------------------------


def sla_by_carrier(star: Star) -> DataFrame:
    """On-time share and mean lead time per carrier and posting month."""
    deliveries = star["fato_entrega"].withColumn("mes", month_start(_c("dt_postagem")))
    return evaluate(
        star.replacing("fato_entrega", deliveries),
        ["otd_pct", "lead_time_medio", "pedidos_abertos"],
        ["dim_transportadora.nome", "mes"],
    )


def ship_from_store(star: Star) -> DataFrame:
    """Share of deliveries per channel leaving from a physical store rather than a depot."""
    df = star.flat("fato_entrega", ["dim_loja.tipo_loja"])
    kind = F.col("`dim_loja.tipo_loja`")
    return df.groupBy("canal_venda").agg(
        F.count(F.lit(1)).alias("entregas"),
        safe_divide(F.count_if(kind == "fisica"), F.count(F.lit(1))).alias("ship_from_store"),
        safe_divide(F.count_if(kind == "cd"), F.count(F.lit(1))).alias("ship_from_cd"),
    )


def bucket(days: Column, edges: Sequence[int]) -> Column:
    """Label of the day range a value falls in: ``0-7``, ``8-15``, ..., ``>90``; negative is ``a_vencer``."""
    out = F.lit(f">{edges[-1]}")
    lower = [0] + [e + 1 for e in edges[:-1]]
    for lo, hi in reversed(list(zip(lower, edges))):
        out = F.when(days <= hi, f"{lo}-{hi}").otherwise(out)
    return F.when(days < 0, "a_vencer").otherwise(out)


def open_order_aging(star: Star, as_of: date, edges: Sequence[int] = (7, 15, 30, 60)) -> DataFrame:
    """Undelivered orders by days since posting."""
    age = F.datediff(F.lit(as_of), "dt_postagem")
    pending = star["fato_entrega"].filter(~_c("fl_entregue") & _c("dt_postagem").isNotNull())
    return pending.groupBy(bucket(age, edges).alias("faixa")).agg(F.count(F.lit(1)).alias("pedidos"))


def receivable_aging(receivables: DataFrame, as_of: date, edges: Sequence[int] = (30, 60, 90)) -> DataFrame:
    """Unpaid receivables by days past due."""
    late = F.datediff(F.lit(as_of), "dt_vencimento")
    open_items = receivables.filter(~_c("status").isin("pago", "cancelado"))
    return open_items.groupBy(bucket(late, edges).alias("faixa")).agg(
        F.count(F.lit(1)).alias("titulos"), F.sum(_c("valor_original") - _c("valor_pago")).alias("valor_aberto")
    )


# -- finance -----------------------------------------------------------------


def profit_and_loss(star: Star) -> DataFrame:
    """Net revenue, cost, gross margin and change over the month before, per month and channel."""
    monthly = _valid(star).groupBy(month_start(_c("dt_pedido_data")).alias("mes"), "canal_venda").agg(
        F.sum("valor_liquido_item").alias("receita_liquida"),
        F.sum(_c("qtd_vendida") * _c("custo_unitario")).alias("cmv"),
        F.sum("margem_bruta_item").alias("margem_bruta"),
    )
    shifted = period_shifts(monthly, "mes", "receita_liquida", {"receita_mes_anterior": (1, 0)}, ["canal_venda"])
    return shifted.select(
        "*",
        safe_divide(_c("margem_bruta"), _c("receita_liquida")).alias("margem_pct"),
        (safe_divide(_c("receita_liquida"), _c("receita_mes_anterior")) - 1).alias("var_mom"),
    )


def instalments(parcels: DataFrame) -> DataFrame:
    """Share of split entries, mean term in days and value concentration per status."""
    per_entry = parcels.groupBy("id_lancamento").agg(
        F.max("numero_parcela").alias("parcelas"), F.sum("valor_parcela").alias("valor")
    )
    summary = per_entry.groupBy((_c("parcelas") > 1).alias("parcelado")).agg(
        F.count(F.lit(1)).alias("lancamentos"), F.sum("valor").alias("valor_total"), mean(_c("parcelas")).alias("prazo_medio")
    )
    return share_of_total(share_of_total(summary, "lancamentos", "pct_lancamentos"), "valor_total", "pct_valor")


# -- marketing ---------------------------------------------------------------


def campaign_returns(star: Star) -> DataFrame:
    """Attributed revenue, return on investment and on ad spend per campaign."""
    both = evaluate(star, ["receita_atribuida", "investimento_campanha", "roi_campanha"], ["dim_campanha.sk_campanha"])
    return both.filter(_c("sk_campanha").isNotNull()).withColumn(
        "roas", safe_divide(F.coalesce("receita_atribuida", F.lit(0)), _c("investimento_campanha"))
    )


def acquisition_cost(star: Star) -> DataFrame:
    """Spend of the campaigns starting in a month over its first-time buyers."""
    spend = star["dim_campanha"].filter("fl_current").groupBy(month_start(_c("dt_inicio")).alias("mes")).agg(
        F.sum("orcamento").alias("investimento")
    )
    new = star["dim_cliente"].filter(_c("fl_current") & _c("primeira_compra").isNotNull()).groupBy(
        month_start(_c("primeira_compra")).alias("mes")
    ).agg(F.count_distinct("sk_cliente").alias("novos_clientes"))
    return spend.join(new, "mes", "full_outer").withColumn(
        "cac", safe_divide(_c("investimento"), _c("novos_clientes"))
    )


def funnel(star: Star) -> DataFrame:
    """Sessions, sessions with cart, and converted sessions per origin.

    Impressions and clicks have no source table, so the funnel starts at sessions.
    """
    return star["fato_cliente_interacao"].groupBy("canal_origem").agg(
        F.count(F.lit(1)).alias("sessoes"),
        F.count_if(_c("qtd_add_cart") > 0).alias("com_carrinho"),
        F.count_if(_c("converteu")).alias("convertidas"),
    ).withColumn("taxa_conversao", safe_divide(_c("convertidas"), _c("sessoes")))


def reactivated_customers(star: Star, inactive_days: int = 90) -> DataFrame:
    """Customers per campaign who bought during it after ``inactive_days`` without a purchase.

    Per customer only the distinct purchase days are kept, each looked at with
    its predecessor; the campaigns of a day come from an equi-join on the day.
    """
    days = _valid(star).select("sk_cliente", _c("dt_pedido_data").alias("dia")).distinct()
    previous = F.lag("dia").over(Window.partitionBy("sk_cliente").orderBy("dia"))
    back = days.withColumn("anterior", previous).filter(F.datediff("dia", "anterior") > inactive_days)
    campaigns = star["dim_campanha"].filter("fl_current").select("sk_campanha", "dt_inicio", "dt_fim")
    hits = interval_join(back, campaigns, "dia", "dt_inicio", "dt_fim")
    return hits.groupBy("sk_campanha").agg(F.count_distinct("sk_cliente").alias("reativados"))


def weighted_attribution(star: Star, attribution: DataFrame) -> DataFrame:
    """Order revenue split over its campaigns by ``peso``."""
    revenue = _valid(star).groupBy("id_pedido_dg").agg(F.sum("valor_liquido_item").alias("receita"))
    return attribution.join(revenue, _c("id_pedido") == _c("id_pedido_dg")).groupBy("id_campanha").agg(
        F.sum(_c("receita") * _c("peso")).alias("receita_atribuida"), F.count(F.lit(1)).alias("pedidos")
    )


def attribution_models(touches: DataFrame, who: str, when: str, channel: str, value: str, tiebreak: str) -> DataFrame:
    """Value per channel under first touch, last touch and equal weights.

    Every customer's value is the sum over their touches.  Customers are reduced
    to one row each by aggregates, so a customer with very many touches costs
    one partial row per task, not one sorted group.
    """
    order = F.struct(when, tiebreak, channel)
    per_customer = touches.groupBy(who).agg(
        F.min(order)[channel].alias("primeiro"),
        F.max(order)[channel].alias("ultimo"),
        F.count(F.lit(1)).alias("toques"),
        F.sum(value).alias("total"),
    )

    def credited(df: DataFrame, by: str, model: str) -> DataFrame:
        return df.groupBy(_c(by).alias("canal")).agg(F.sum("total").cast("double").alias("valor")).select(
            F.lit(model).alias("modelo"), "canal", "valor"
        )

    per_channel = touches.groupBy(who, channel).agg(F.count(F.lit(1)).alias("no_canal"))
    linear = per_channel.join(per_customer.select(who, "toques", "total"), who).groupBy(
        _c(channel).alias("canal")
    ).agg(F.sum(safe_divide(_c("total") * _c("no_canal"), _c("toques"))).alias("valor"))
    return (
        credited(per_customer, "primeiro", "first_touch")
        .unionByName(credited(per_customer, "ultimo", "last_touch"))
        .unionByName(linear.select(F.lit("linear").alias("modelo"), "canal", "valor"))
    )


def seller_performance(star: Star, commissions: DataFrame, targets: DataFrame) -> DataFrame:
    """Sales per seller and month against the target."""
    month = _c("dt_competencia")
    sold = commissions.groupBy("id_vendedor", F.year(month).alias("ano"), F.month(month).alias("mes")).agg(
        F.sum("valor_venda").alias("receita"), F.count_distinct("id_pedido").alias("pedidos")
    )
    goals = targets.groupBy("id_vendedor", "ano", "mes").agg(
        F.sum("meta_valor").alias("meta_valor"), F.sum("meta_qtd_pedidos").alias("meta_pedidos")
    )
    sellers = star["dim_vendedor"].filter("fl_current").select(
        _c("id_vendedor_nk").alias("id_vendedor"), "nome", "nome_loja"
    )
    return (
        goals.join(sold, ["id_vendedor", "ano", "mes"], "full_outer")
        .join(sellers, "id_vendedor", "left")
        .withColumn("atingimento", safe_divide(_c("receita"), _c("meta_valor")))
    )
