"""The ten dimensions.

Five of them carry version columns.  As built here they hold one current row
per key; :func:`emporio.operators.scd2.scd2_apply` turns successive builds into
real history.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporio.config import WarehouseConfig
from emporio.functions import calendar as cal
from emporio.functions.keys import date_key, surrogate_key
from emporio.functions.rfm import rfm_segment
from emporio.operators.scd2 import scd2_columns
from emporio.sources.reference import channels, date_spine, holidays

Frames = Mapping[str, DataFrame]

# Natural key and attributes whose change opens a version, per versioned dimension.
VERSIONED = {
    "dim_cliente": ("id_cliente_nk", ("nivel_fidelidade", "ltv", "qtd_pedidos", "uf")),
    "dim_produto": ("id_produto_nk", ("preco_venda_vigente", "custo_vigente", "ativo")),
    "dim_loja": ("id_loja_nk", ("gerente", "ativo", "nome_loja")),
    "dim_vendedor": ("id_vendedor_nk", ("cargo", "ativo", "id_loja")),
    "dim_campanha": ("id_campanha_nk", ("nome", "ativo", "orcamento")),
}


def calendar_columns(days: DataFrame, holiday_dates: DataFrame, day_bound: int, extras: bool = False) -> DataFrame:
    """Calendar attributes of a frame of distinct ``data_full`` days."""
    d = F.col("data_full")
    # At most a dozen holidays a year, so bounded by the number of days.
    marks = F.broadcast(holiday_dates.select(F.col("data").alias("__holiday")).distinct())
    holiday = F.col("__holiday").isNotNull()
    columns = [
        date_key(d).alias("sk_tempo"),
        d,
        F.year(d).alias("ano"),
        F.month(d).alias("mes"),
        F.dayofmonth(d).alias("dia"),
        F.quarter(d).alias("trimestre"),
        F.weekofyear(d).alias("semana_iso"),
        cal.weekday(d).alias("dia_semana_num"),
        cal.month_name(d).alias("nome_mes"),
        cal.weekday_name(d).alias("nome_dia_semana"),
        cal.quarter_label(d).alias("nome_trimestre"),
        cal.is_weekend(d).alias("fl_fim_de_semana"),
        holiday.alias("fl_feriado_nacional"),
        cal.is_black_friday(d).alias("fl_black_friday"),
        cal.year_month(d).alias("ano_mes"),
        cal.year_quarter(d).alias("ano_trimestre"),
    ]
    if extras:
        columns += [
            cal.half_year(d).alias("semestre"),
            (~cal.is_weekend(d) & ~holiday).alias("fl_dia_util"),
        ]
    return days.join(marks, d == F.col("__holiday"), "left").select(*columns)


def build_calendar(spark: SparkSession, cfg: WarehouseConfig, seed: DataFrame | None = None, extras: bool = False) -> DataFrame:
    """``dim_tempo``: one row per day of the configured range (M1)."""
    if seed is None:
        seed = holidays(spark, cfg.calendar_start.year, cfg.calendar_end.year)
    return calendar_columns(date_spine(spark, cfg.calendar_start, cfg.calendar_end), seed, cfg.calendar_days, extras)


def build_channel(spark: SparkSession) -> DataFrame:
    """``dim_canal_venda``: the five channels (M7)."""
    return channels(spark).select(surrogate_key("canal_venda").alias("sk_canal_venda"), "*")


def build_customer(dfs: Frames, cfg: WarehouseConfig) -> DataFrame:
    """``dim_cliente`` with segment and version columns (M2)."""
    people = dfs["int_clientes__unificados"]
    scores = [F.col(f"score_{s}") for s in ("recencia", "frequencia", "monetario")]
    rows = people.select(
        surrogate_key("id_cliente").alias("sk_cliente"),
        F.col("id_cliente").alias("id_cliente_nk"),
        "cpf",
        "email",
        "primeiro_nome",
        "nome_completo",
        "cep",
        "cidade",
        "uf",
        "data_cadastro",
        "canal_origem",
        "nivel_fidelidade",
        "qtd_pedidos",
        F.round("ltv", 2).alias("ltv"),
        "ultima_compra",
        "primeira_compra",
        "recencia_dias",
        *scores,
        rfm_segment(*scores).alias("segmento_rfm"),
        "saldo_techpoints",
        "ativo",
    )
    return scd2_columns(rows, F.col("data_cadastro"), VERSIONED["dim_cliente"][1])


def build_product(dfs: Frames, cfg: WarehouseConfig) -> DataFrame:
    """``dim_produto`` with the current price; valid from the day of the build (M3)."""
    rows = dfs["int_produtos__catalogo"].select(
        surrogate_key("id_produto").alias("sk_produto"),
        F.col("id_produto").alias("id_produto_nk"),
        "sku",
        "nome_produto",
        "marca",
        "categoria",
        "subcategoria",
        "id_categoria",
        "nome_fornecedor",
        "cnpj_fornecedor",
        "pais_origem",
        "prazo_entrega_dias",
        "peso_kg",
        "preco_venda_vigente",
        "custo_vigente",
        "margem_pct_vigente",
        "ativo",
    )
    return scd2_columns(rows, F.lit(cfg.today), VERSIONED["dim_produto"][1])


def build_store(dfs: Frames, cfg: WarehouseConfig) -> DataFrame:
    """``dim_loja`` with kind flags (M4)."""
    kind = F.col("tipo_loja")
    rows = dfs["stg_rh__lojas"].select(
        surrogate_key("id_loja").alias("sk_loja"),
        F.col("id_loja").alias("id_loja_nk"),
        "codigo",
        "nome_loja",
        kind,
        "regiao",
        "cidade",
        "uf",
        "gerente",
        "capacidade_m2",
        "dt_abertura",
        "ativo",
        (kind == "fisica").alias("fl_loja_fisica"),
        (kind == "ecommerce").alias("fl_ecommerce"),
    )
    return scd2_columns(rows, F.col("dt_abertura"), VERSIONED["dim_loja"][1])


def build_seller(dfs: Frames, cfg: WarehouseConfig) -> DataFrame:
    """``dim_vendedor`` with the store's name, region and state (M5)."""
    stores = dfs["stg_rh__lojas"].select("id_loja", "nome_loja", "regiao", "uf")
    rows = dfs["stg_rh__vendedores"].join(stores, "id_loja", "left").select(
        surrogate_key("id_vendedor").alias("sk_vendedor"),
        F.col("id_vendedor").alias("id_vendedor_nk"),
        "nome",
        "cpf",
        "email",
        "cargo",
        "data_admissao",
        "ativo",
        "id_loja",
        "nome_loja",
        "regiao",
        "uf",
    )
    return scd2_columns(rows, F.col("data_admissao"), VERSIONED["dim_vendedor"][1])


def build_campaign(dfs: Frames, cfg: WarehouseConfig) -> DataFrame:
    """``dim_campanha``; the length counts both end days (M6)."""
    start, end = F.col("dt_inicio"), F.col("dt_fim")
    rows = dfs["stg_marketing__campanhas"].select(
        surrogate_key("id_campanha").alias("sk_campanha"),
        F.col("id_campanha").alias("id_campanha_nk"),
        "nome",
        "tipo",
        "canal",
        start,
        end,
        (F.datediff(end, start) + 1).alias("duracao_dias"),
        "orcamento",
        "objetivo",
        "ativo",
        F.year(start).alias("ano_campanha"),
    )
    return scd2_columns(rows, start, VERSIONED["dim_campanha"][1])


def build_carrier(dfs: Frames, cfg: WarehouseConfig) -> DataFrame:
    """``dim_transportadora`` with the middle of its delivery range (M8)."""
    middle = (F.col("prazo_dias_min") + F.col("prazo_dias_max")).cast("decimal(12,1)") / F.lit(2)
    return dfs["stg_logistica__transportadoras"].select(
        surrogate_key("id_transportadora").alias("sk_transportadora"),
        F.col("id_transportadora").alias("id_transportadora_nk"),
        "nome",
        "cnpj",
        "prazo_dias_min",
        "prazo_dias_max",
        F.round(middle, 1).cast("double").alias("prazo_medio_dias"),
        "ativo",
    )


def build_supplier(dfs: Frames, cfg: WarehouseConfig) -> DataFrame:
    """``dim_fornecedor`` with the import flag (M9)."""
    return dfs["stg_produtos__fornecedores"].select(
        surrogate_key("id_fornecedor").alias("sk_fornecedor"),
        F.col("id_fornecedor").alias("id_fornecedor_nk"),
        "nome_fornecedor",
        "cnpj",
        "categoria_principal",
        "pais_origem",
        "prazo_entrega_dias",
        "ativo",
        (F.col("pais_origem") != "Brasil").alias("fl_importado"),
    )


def build_delivery_mode(dfs: Frames, cfg: WarehouseConfig) -> DataFrame:
    """``dim_modalidade_entrega`` with the carrier's name and the pick-up flag."""
    carriers = dfs["stg_logistica__transportadoras"].select(
        "id_transportadora", F.col("nome").alias("nome_transportadora")
    )
    return dfs["stg_logistica__modalidades"].join(carriers, "id_transportadora", "left").select(
        surrogate_key("id_modalidade").alias("sk_modalidade_entrega"),
        F.col("id_modalidade").alias("id_modalidade_nk"),
        "codigo",
        F.col("nome").alias("nome_modalidade"),
        "tipo",
        "prazo_dias",
        "frete_base",
        "nome_transportadora",
        ((F.col("tipo") == "loja") & (F.col("frete_base") == 0)).alias("fl_retirada_loja"),
    )
