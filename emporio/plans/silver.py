"""Conformed intermediates: orders, customers, product catalogue."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporio.config import WarehouseConfig
from emporio.functions.numeric import ratio
from emporio.functions.rfm import NEVER_BOUGHT_DAYS, loyalty_level, rfm_frequency, rfm_monetary, rfm_recency
from emporio.operators.dedup import first_per_key
from emporio.operators.joins import join_aggregate

Frames = Mapping[str, DataFrame]

CANCELLED, RETURNED = "cancelado", "devolvido"


def final_status(status: str | Column, approved_returns: Column) -> Column:
    """Cancelled beats returned beats the recorded status.

    The remaining levels of the hierarchy (delivered, shipped) equal the
    recorded status, so they need no case of their own.
    """
    own = F.col(status) if isinstance(status, str) else status
    return F.when(own == CANCELLED, own).when(approved_returns > 0, F.lit(RETURNED)).otherwise(own)


def build_orders(dfs: Frames, cfg: WarehouseConfig) -> DataFrame:
    """``int_vendas__pedidos_unificados``: one row per order.

    Items and returns are aggregated before the join, and the status hierarchy
    is computed in the same pass.  All three inputs are hashed by the order id
    once.
    """
    items = dfs["stg_vendas__itens_pedido"].groupBy("id_pedido").agg(
        F.count(F.lit(1)).alias("qtd_itens"),
        F.sum("qtd_vendida").alias("qtd_total_produtos"),
        F.sum(F.col("qtd_vendida") * F.col("custo_unitario")).alias("custo_total"),
    )
    returns = dfs["stg_vendas__devolucoes"].filter("status = 'aprovada'").groupBy("id_pedido").agg(
        F.count(F.lit(1)).alias("qtd_devolucoes"),
        F.sum("valor_devolvido").alias("valor_devolvido_total"),
    )
    orders = join_aggregate(
        dfs["stg_vendas__pedidos"], items, ["id_pedido"], ["qtd_itens", "qtd_total_produtos", "custo_total"]
    )
    orders = join_aggregate(orders, returns, ["id_pedido"], ["qtd_devolucoes", "valor_devolvido_total"])
    gross = F.col("valor_bruto")
    return orders.select(
        "id_pedido",
        "id_cliente",
        "id_loja",
        "canal_venda",
        final_status("status", F.col("qtd_devolucoes")).alias("status"),
        "dt_pedido",
        F.to_date("dt_pedido").alias("dt_pedido_data"),
        "dt_confirmacao",
        "dt_cancelamento",
        "valor_bruto",
        "valor_desconto",
        "valor_frete",
        "valor_liquido",
        "qtd_itens",
        "qtd_total_produtos",
        "custo_total",
        F.round(F.col("valor_liquido") - F.col("custo_total"), 2).alias("margem_bruta"),
        F.when(gross > 0, ratio(F.col("valor_desconto"), gross)).otherwise(0.0).alias("taxa_desconto"),
        "parcelas",
        "metodo_pagamento",
        "cupom",
        "id_campanha",
        "qtd_devolucoes",
        "valor_devolvido_total",
        "updated_at",
        "_ingested_at",
    )


def build_customers(dfs: Frames, cfg: WarehouseConfig) -> DataFrame:
    """``int_clientes__unificados``: one row per CPF with purchase history and scores."""
    people = dfs["stg_clientes__clientes"].filter((F.col("cpf").isNotNull()) & (F.col("cpf") != ""))
    # Deduplication sees every staged customer, whatever part of them a run refreshes.
    people = first_per_key(people, ["cpf"], [F.asc_nulls_last("data_cadastro"), F.asc("id_cliente")])
    bought = dfs["stg_vendas__pedidos"].filter(F.col("status") != CANCELLED).groupBy("id_cliente").agg(
        F.count(F.lit(1)).alias("qtd_pedidos"),
        F.sum("valor_liquido").alias("ltv"),
        F.max(F.to_date("dt_pedido")).alias("ultima_compra"),
        F.min(F.to_date("dt_pedido")).alias("primeira_compra"),
    )
    points = dfs["stg_clientes__techpoints"].select("id_cliente", F.col("saldo_pontos").alias("saldo_techpoints"))
    main = first_per_key(
        dfs["stg_clientes__enderecos"].filter("tipo = 'principal'"),
        ["id_cliente"],
        [F.desc_nulls_last("updated_at"), F.asc("id_endereco")],
    ).select("id_cliente", *[F.col(c).alias(f"{c}_principal") for c in ("cep", "cidade", "uf")])

    joined = join_aggregate(people, bought, ["id_cliente"], ["qtd_pedidos", "ltv"])
    joined = join_aggregate(joined, points, ["id_cliente"], ["saldo_techpoints"])
    joined = joined.join(main, "id_cliente", "left")
    recency = F.datediff(F.lit(cfg.end_date), "ultima_compra")
    return joined.select(
        "id_cliente",
        "cpf",
        "email",
        "telefone",
        "primeiro_nome",
        "nome_completo",
        *[F.coalesce(f"{c}_principal", c).alias(c) for c in ("cep", "cidade", "uf")],
        "data_cadastro",
        "canal_origem",
        loyalty_level(F.col("ltv"), F.col("qtd_pedidos")).alias("nivel_fidelidade"),
        "qtd_pedidos",
        "ltv",
        "ultima_compra",
        "primeira_compra",
        recency.alias("recencia_dias"),
        rfm_recency(F.coalesce(recency, F.lit(NEVER_BOUGHT_DAYS))).alias("score_recencia"),
        rfm_frequency(F.col("qtd_pedidos")).alias("score_frequencia"),
        rfm_monetary(F.col("ltv")).alias("score_monetario"),
        "saldo_techpoints",
        "ativo",
        "updated_at",
        "_ingested_at",
    )


def current_prices(prices: DataFrame, cfg: WarehouseConfig) -> DataFrame:
    """Price with the latest start among those not ended before the anchor date."""
    ends = F.col("dt_vigencia_fim")
    valid = prices.filter(ends.isNull() | (ends >= F.lit(cfg.end_date)))
    return first_per_key(valid, ["id_produto"], [F.desc("dt_vigencia_inicio"), F.asc("id_preco")])


def build_catalog(dfs: Frames, cfg: WarehouseConfig) -> DataFrame:
    """``int_produtos__catalogo``: product with category, supplier and current price."""
    prices = current_prices(dfs["stg_produtos__precos"], cfg).select("id_produto", "preco_venda", "custo_unitario")
    categories = dfs["stg_produtos__categorias"].select(
        F.col("id_categoria").alias("categoria_id"), F.col("nome").alias("categoria"), "subcategoria"
    )
    suppliers = dfs["stg_produtos__fornecedores"].select(
        F.col("id_fornecedor").alias("fornecedor_id"),
        "nome_fornecedor",
        F.col("cnpj").alias("cnpj_fornecedor"),
        "pais_origem",
        "prazo_entrega_dias",
    )
    products = dfs["stg_produtos__produtos"]
    joined = (
        products.join(prices, "id_produto", "left")
        .join(categories, F.col("id_categoria") == F.col("categoria_id"), "left")
        .join(suppliers, F.col("id_fornecedor") == F.col("fornecedor_id"), "left")
    )
    price, cost = F.col("preco_venda"), F.col("custo_unitario")
    return joined.select(
        "id_produto",
        "sku",
        F.col("nome").alias("nome_produto"),
        "marca",
        "peso_kg",
        "ativo",
        F.col("categoria_id").alias("id_categoria"),
        "categoria",
        "subcategoria",
        F.col("fornecedor_id").alias("id_fornecedor"),
        "nome_fornecedor",
        "cnpj_fornecedor",
        "pais_origem",
        "prazo_entrega_dias",
        price.alias("preco_venda_vigente"),
        cost.alias("custo_vigente"),
        ratio(price - cost, price).alias("margem_pct_vigente"),
        "updated_at",
        "_ingested_at",
    )
