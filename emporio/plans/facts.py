"""The six facts.

Each keeps the natural ids it was joined on as degenerate keys, and carries
``_ingested_at`` so that an incremental run can find its own high-water mark.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporio.config import WarehouseConfig
from emporio.functions.keys import ANONYMOUS, NO_CAMPAIGN, UNKNOWN, UNKNOWN_DATE, date_key, surrogate_key
from emporio.functions.numeric import ratio, round_ratio, safe_divide
from emporio.operators.dedup import first_per_key, latest_per_key
from emporio.operators.joins import Lookup, join_aggregate, left_join_sparse, star_lookup
from emporio.plans.aggregates import Sums
from emporio.sinks.tables import month_partition

Frames = Mapping[str, DataFrame]

# Dimension: its natural key, and the fact's column and value for a miss.
DIMENSION_KEYS = {
    "dim_cliente": ("id_cliente_nk", "sk_cliente", UNKNOWN),
    "dim_produto": ("id_produto_nk", "sk_produto", UNKNOWN),
    "dim_loja": ("id_loja_nk", "sk_loja", UNKNOWN),
    "dim_canal_venda": ("canal_venda", "sk_canal_venda", UNKNOWN),
    "dim_campanha": ("id_campanha_nk", "sk_campanha", NO_CAMPAIGN),
    "dim_transportadora": ("id_transportadora_nk", "sk_transportadora", UNKNOWN),
    "dim_modalidade_entrega": ("id_modalidade_nk", "sk_modalidade_entrega", UNKNOWN),
}

# What a fact holds where a dimension has no row, yet.
MISSES = (UNKNOWN, NO_CAMPAIGN, ANONYMOUS)


def _key(dfs: Frames, dim: str, on: str, default: str | None = None, **options) -> Lookup:
    natural, alias, miss = DIMENSION_KEYS[dim]
    return Lookup(dfs[dim], on, natural, surrogate_key, default or miss, alias, **options)


def _date(dfs: Frames, cfg: WarehouseConfig, day: str | Column, alias: str = "sk_tempo") -> Lookup:
    return Lookup(dfs["dim_tempo"], day, "data_full", date_key, UNKNOWN_DATE, alias, bounded=True)


# Columns of a fact before it is stored: surrogate key, the natural key of the dimension's row, NULL on a miss.
FOUND_KEYS = {"sk_produto": "__id_produto"}


def found_surrogate(alias: str) -> Column:
    """The surrogate ``alias`` of the natural key that was found."""
    natural = F.col(FOUND_KEYS[alias])
    miss = next(m for _, sk, m in DIMENSION_KEYS.values() if sk == alias)
    return F.coalesce(F.when(natural.isNotNull(), surrogate_key(natural)), F.lit(miss)).alias(alias)


def sales_by_natural(dfs: Frames, cfg: WarehouseConfig) -> DataFrame:
    """``fato_venda`` with ``FOUND_KEYS``, for groups that are made before it is stored."""
    orders = dfs["int_vendas__pedidos_unificados"].drop("updated_at", "_ingested_at")
    items = dfs["stg_vendas__itens_pedido"].drop("updated_at")
    commissions = dfs["stg_rh__comissoes"]
    if cfg.fan_out:
        commissions = commissions.select("id_pedido", "valor_comissao")
    else:
        commissions = commissions.groupBy("id_pedido").agg(F.sum("valor_comissao").alias("valor_comissao"))
    # Customer, store, campaign, day and channel are known per order: looked up before the items multiply the rows.
    # The two lookups without a shuffle and the joins by order id come next to one another.
    orders = star_lookup(
        orders,
        _key(dfs, "dim_cliente", "id_cliente"),
        _key(dfs, "dim_loja", "id_loja"),
        _key(dfs, "dim_campanha", "id_campanha", spread_nulls_by="id_pedido"),
        _date(dfs, cfg, "dt_pedido_data"),
        _key(dfs, "dim_canal_venda", "canal_venda", bounded=True),
    )
    rows = orders.join(commissions, "id_pedido", "left").join(items, "id_pedido")
    rows = star_lookup(rows, _key(dfs, "dim_produto", "id_produto", natural_alias=FOUND_KEYS["sk_produto"]))
    net, discount, status = F.col("valor_liquido_item"), F.col("desconto_item"), F.col("status")
    cost = F.col("qtd_vendida") * F.col("custo_unitario")
    return rows.select(
        surrogate_key("id_pedido", "id_item_pedido").alias("sk_venda"),
        "sk_cliente",
        "sk_produto",
        "sk_loja",
        "sk_tempo",
        "sk_canal_venda",
        "sk_campanha",
        F.col("id_pedido").alias("id_pedido_dg"),
        F.col("id_item_pedido").alias("id_item_pedido_dg"),
        "dt_pedido_data",
        "dt_pedido",
        "dt_confirmacao",
        "qtd_vendida",
        "preco_unitario",
        "custo_unitario",
        discount,
        net,
        F.round(net - cost, 2).alias("margem_bruta_item"),
        ratio(discount, discount + net).alias("taxa_desconto_item"),
        *[F.col(c).alias(f"{c}_pedido") for c in
          ("valor_bruto", "valor_desconto", "valor_frete", "valor_liquido", "qtd_itens")],
        "parcelas",
        "metodo_pagamento",
        status,
        (~status.isin("cancelado", "devolvido")).alias("fl_venda_valida"),
        (status == "cancelado").alias("fl_cancelado"),
        ((status == "devolvido") | (F.col("qtd_devolucoes") > 0)).alias("fl_devolvido"),
        (F.col("canal_venda") != "loja_fisica").alias("fl_online"),
        F.coalesce("valor_comissao", F.lit(0)).alias("valor_comissao"),
        "canal_venda",
        "_ingested_at",
        *FOUND_KEYS.values(),
    )


def build_sales(dfs: Frames, cfg: WarehouseConfig) -> DataFrame:
    """``fato_venda``: one row per order item (G1)."""
    return sales_by_natural(dfs, cfg).drop(*FOUND_KEYS.values())


def daily_movements(movements: DataFrame) -> DataFrame:
    """Stock in and out per product, store and day."""
    qty = F.col("qtd")
    return movements.groupBy("id_produto", "id_loja", F.to_date("dt_movimentacao").alias("dia")).agg(
        F.sum(F.when(qty > 0, qty).otherwise(0)).alias("qtd_entrada_dia"),
        F.sum(F.when(qty < 0, -qty).otherwise(0)).alias("qtd_saida_dia"),
        F.count_distinct("id_pedido").alias("qtd_pedidos_movs"),
    )


def stock_by_natural(dfs: Frames, cfg: WarehouseConfig) -> DataFrame:
    """``fato_estoque`` with ``FOUND_KEYS``, for groups that are made before it is stored."""
    day = F.col("dt_ultima_atualizacao")
    moves = daily_movements(dfs["stg_estoque__movimentacoes"]).withColumnRenamed("dia", "dt_ultima_atualizacao")
    rows = join_aggregate(
        dfs["stg_estoque__saldo_estoque"],
        moves,
        ["id_produto", "id_loja", "dt_ultima_atualizacao"],
        ["qtd_entrada_dia", "qtd_saida_dia", "qtd_pedidos_movs"],
    )
    rows = star_lookup(
        rows,
        _key(dfs, "dim_produto", "id_produto", natural_alias=FOUND_KEYS["sk_produto"]),
        _key(dfs, "dim_loja", "id_loja"),
        _date(dfs, cfg, "dt_ultima_atualizacao"),
    )
    available = F.col("qtd_disponivel")
    return rows.select(
        surrogate_key("id_produto", "id_loja", day).alias("sk_estoque"),
        "sk_produto",
        "sk_loja",
        "sk_tempo",
        F.col("id_produto").alias("id_produto_nk"),
        F.col("id_loja").alias("id_loja_nk"),
        day,
        available,
        "qtd_reservada",
        "qtd_minima",
        (available + F.col("qtd_reservada")).alias("qtd_total"),
        (available <= F.col("qtd_minima")).alias("fl_estoque_critico"),
        (available == 0).alias("fl_ruptura"),
        "qtd_entrada_dia",
        "qtd_saida_dia",
        "qtd_pedidos_movs",
        "_ingested_at",
        *FOUND_KEYS.values(),
    )


def build_stock(dfs: Frames, cfg: WarehouseConfig) -> DataFrame:
    """``fato_estoque``: product, store and snapshot date.

    ``stg_estoque__saldo_estoque`` may hold several dates per product and store
    (see :func:`stock_snapshots`); each becomes a row.
    """
    return stock_by_natural(dfs, cfg).drop(*FOUND_KEYS.values())


def stock_snapshots(balances: DataFrame) -> DataFrame:
    """Newest balance version per product, store and date over all Bronze batches.

    Staging keeps one row per product and store, so the history of balances is
    only in the versions; a rebuild of G2 starts from here.
    """
    return latest_per_key(
        balances, ["id_produto", "id_loja", "dt_ultima_atualizacao"], ("updated_at", "_ingested_at")
    )


def build_delivery(dfs: Frames, cfg: WarehouseConfig) -> DataFrame:
    """``fato_entrega``: one row per delivery (G3).  The delay is negative when early."""
    orders = dfs["stg_vendas__pedidos"].select("id_pedido", "id_cliente", "canal_venda")
    rows = left_join_sparse(dfs["stg_logistica__entregas"].drop("updated_at"), orders, "id_pedido", "id_entrega")
    rows = star_lookup(
        rows,
        _key(dfs, "dim_cliente", "id_cliente"),
        _key(dfs, "dim_loja", "id_loja_origem"),
        _key(dfs, "dim_transportadora", "id_transportadora"),
        _key(dfs, "dim_modalidade_entrega", "id_modalidade"),
        _date(dfs, cfg, "dt_postagem", "sk_tempo_postagem"),
    )
    return rows.select(
        surrogate_key("id_entrega").alias("sk_entrega"),
        "sk_cliente",
        "sk_loja",
        "sk_transportadora",
        "sk_modalidade_entrega",
        "sk_tempo_postagem",
        F.col("id_entrega").alias("id_entrega_dg"),
        F.col("id_pedido").alias("id_pedido_dg"),
        "codigo_rastreio",
        "dt_postagem",
        "dt_promessa",
        "dt_efetiva",
        # datediff is NULL when either date is, which is what the open cases need (P5).
        F.datediff("dt_promessa", "dt_postagem").alias("lead_time_prometido_dias"),
        F.datediff("dt_efetiva", "dt_postagem").alias("lead_time_real_dias"),
        F.datediff("dt_efetiva", "dt_promessa").alias("atraso_dias"),
        "fl_sla_atendido",
        (F.col("status") == "entregue").alias("fl_entregue"),
        "status",
        "canal_venda",
        "_ingested_at",
    )


# Ledger entry types that reduce the result.
NEGATIVE_TYPES = ("desconto", "custo_produto", "frete_custo", "comissao")


def build_ledger(dfs: Frames, cfg: WarehouseConfig) -> DataFrame:
    """``fato_financeiro``: one row per ledger entry.

    Unless ``cfg.fan_out``, an order with several receivables contributes the
    one due last, so entries are not multiplied.
    """
    receivables = dfs["stg_financeiro__contas_receber"].select(
        "id_pedido", "id_conta", "dt_vencimento", F.col("status").alias("status_cr"), "dt_pagamento", "valor_pago"
    )
    if not cfg.fan_out:
        receivables = first_per_key(
            receivables, ["id_pedido"], [F.desc_nulls_last("dt_vencimento"), F.desc("id_conta")]
        )
    entries = dfs["stg_financeiro__lancamentos"].drop("updated_at")
    rows = left_join_sparse(entries, receivables.drop("id_conta", "dt_vencimento"), "id_pedido", "id_lancamento")
    rows = star_lookup(
        rows, _key(dfs, "dim_loja", "id_loja"), _date(dfs, cfg, "dt_competencia", "sk_tempo_competencia")
    )
    value = F.col("valor")
    return rows.select(
        surrogate_key("id_lancamento").alias("sk_lancamento"),
        "sk_loja",
        "sk_tempo_competencia",
        F.col("id_lancamento").alias("id_lancamento_dg"),
        F.col("id_pedido").alias("id_pedido_dg"),
        "tipo",
        value,
        "dt_lancamento",
        "dt_competencia",
        "descricao",
        F.when(F.col("tipo").isin(*NEGATIVE_TYPES), -value).otherwise(value).alias("valor_sinal"),
        "status_cr",
        "dt_pagamento",
        "valor_pago",
        (F.col("status_cr") == "pago").alias("fl_pago"),
        "_ingested_at",
    )


def cart_activity(events: DataFrame) -> DataFrame:
    """Cart events per session: distinct products and one counter per kind."""

    def counted(kind: str):
        return F.count_if(F.col("tipo_evento") == kind)

    return events.groupBy("id_sessao").agg(
        F.count_distinct("id_produto").alias("qtd_produtos_vistos"),
        counted("add_to_cart").alias("qtd_add_cart"),
        counted("remove_from_cart").alias("qtd_remove_cart"),
        counted("purchase").alias("qtd_compras"),
    )


def build_sessions(dfs: Frames, cfg: WarehouseConfig) -> DataFrame:
    """``fato_cliente_interacao``: one row per web session."""
    sessions = dfs["stg_web_analytics__sessoes"].drop("updated_at")
    rows = sessions.join(cart_activity(dfs["stg_web_analytics__eventos_carrinho"]), "id_sessao", "left")
    rows = star_lookup(
        rows,
        _key(dfs, "dim_cliente", "id_cliente", ANONYMOUS, spread_nulls_by="id_sessao"),
        _date(dfs, cfg, F.to_date("dt_inicio")),
    )
    counters = ("qtd_produtos_vistos", "qtd_add_cart", "qtd_remove_cart", "qtd_compras")
    return rows.select(
        surrogate_key("id_sessao").alias("sk_sessao"),
        "sk_cliente",
        "sk_tempo",
        F.col("id_sessao").alias("id_sessao_dg"),
        F.col("id_pedido").alias("id_pedido_dg"),
        "canal_origem",
        "device_type",
        "dt_inicio",
        "dt_fim",
        "paginas_visitadas",
        (F.timestamp_diff("MICROSECOND", F.col("dt_inicio"), F.col("dt_fim")) / F.lit(60e6)).alias("duracao_min"),
        "converteu",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counters],
        # On the counter before its zero default: a session without events is NULL, not FALSE.
        ((F.col("qtd_add_cart") > 0) & ~F.col("converteu")).alias("fl_abandono_carrinho"),
        F.to_date("dt_inicio").alias("dt_sessao"),
        "_ingested_at",
    )


def sales_by_month() -> Sums:
    """Valid sales per store, channel, year and month."""
    day = F.col("dt_pedido_data")
    return Sums(
        "agg_venda_mes",
        "fato_venda",
        {"sk_loja": F.col("sk_loja"), "canal_venda": F.col("canal_venda"), "ano": F.year(day), "mes": F.month(day)},
        {"receita_realizada": F.col("valor_liquido_item"), "margem_realizada": F.col("margem_bruta_item")},
        month_partition(day),
        F.col("fl_venda_valida"),
        {"qtd_pedidos_realizados": F.col("id_pedido_dg")},
    )


def realised_sales(dfs: Frames) -> DataFrame:
    """Valid sales per store, channel, year and month, from the kept sums if there are any."""
    spec = sales_by_month()
    stores = dfs["dim_loja"].select("sk_loja", F.col("id_loja_nk").alias("id_loja"))
    sales = dfs[spec.name] if spec.name in dfs else spec.groups(dfs[spec.fact])
    # One store row per surrogate key, so the aggregate can be joined after grouping.
    return sales.join(stores.dropDuplicates(["sk_loja"]), "sk_loja").drop("sk_loja")


def build_budget(dfs: Frames, cfg: WarehouseConfig) -> DataFrame:
    """``fato_orcamento``: target against actual per store, channel and month."""
    rows = join_aggregate(
        dfs["stg_financeiro__orcamentos"],
        realised_sales(dfs),
        ["id_loja", "canal_venda", "ano", "mes"],
        ["receita_realizada", "margem_realizada", "qtd_pedidos_realizados"],
    ).withColumn("dt_inicio_mes", F.make_date("ano", "mes", F.lit(1)))
    rows = star_lookup(rows, _key(dfs, "dim_loja", "id_loja"), _date(dfs, cfg, "dt_inicio_mes"))
    revenue, margin = F.col("receita_realizada"), F.col("margem_realizada")
    target, margin_target = F.col("valor_meta_receita"), F.col("valor_meta_margem")
    return rows.select(
        surrogate_key("id_orcamento").alias("sk_orcamento"),
        "sk_loja",
        "sk_tempo",
        F.col("id_orcamento").alias("id_orcamento_dg"),
        F.col("id_loja").alias("id_loja_nk"),
        "canal_venda",
        "ano",
        "mes",
        "dt_inicio_mes",
        target,
        margin_target,
        "qtd_meta_pedidos",
        revenue,
        margin,
        "qtd_pedidos_realizados",
        round_ratio(safe_divide(revenue, target) - 1).alias("var_receita_pct"),
        round_ratio(safe_divide(margin, margin_target) - 1).alias("var_margem_pct"),
        (revenue >= target).alias("fl_meta_receita_atingida"),
        (F.col("qtd_pedidos_realizados") >= F.col("qtd_meta_pedidos")).alias("fl_meta_pedidos_atingida"),
        "_ingested_at",
    )
