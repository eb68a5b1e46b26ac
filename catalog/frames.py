"""Models over the given tables, built on first use."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from catalog.source_views import GIVEN, VIEWS, given_tables
from emporio.config import WarehouseConfig
from emporio.operators.dedup import latest_per_key
from emporio.plans import dimensions as dims
from emporio.plans import facts, silver
from emporio.plans.star import Star
from emporio.plans.warehouse import DIMENSIONS, INCREMENTAL
from emporio.registry import TABLES_BY_NAME
from emporio.session import configure

# Dates of the given data stand in for the defaults; the calendar leaves out some days at both ends.
CONFIG = WarehouseConfig(
    start_date=date(1995, 1, 1),
    end_date=date(2001, 8, 1),
    calendar_start=date(1995, 2, 1),
    calendar_end=date(2024, 1, 25),
    as_of=date(2001, 7, 31),
)


_SHARED: dict[tuple[str, int, str], Models] = {}


def models(spark: SparkSession, sf_dir: str) -> Models:
    """Frames of a data directory, shared by the queries of a session.

    Frames are plans, not data: sharing them saves listing the files and
    analysing the same models again, and nothing is kept in memory.
    """
    key = (spark.sparkContext.applicationId, id(spark), sf_dir.rstrip("/"))
    if key not in _SHARED:
        _SHARED[key] = Models(spark, sf_dir)
    configure(spark)
    return _SHARED[key]


class Models(Mapping[str, DataFrame]):
    """``src_``/``stg_``/``int_``/``dim_``/``fato_`` frames by name; only what is asked for is built."""

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: WarehouseConfig = CONFIG):
        self.spark, self.sf_dir, self.cfg = configure(spark), sf_dir.rstrip("/"), cfg
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._built)

    def __len__(self) -> int:
        return len(self._built)

    @property
    def star(self) -> Star:
        return Star(self)

    def source(self, full_name: str) -> DataFrame:
        """An operational table as derived from the given ones."""
        return self["src_" + full_name]

    def _build(self, name: str) -> DataFrame:
        if name in GIVEN:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name.startswith("src_"):
            sql = VIEWS[name.removeprefix("src_")]
            return self.spark.sql(sql, **{t: self[t] for t in given_tables(sql)})
        if name == "stg_estoque__saldo_estoque":
            return facts.stock_snapshots(self.source("estoque.saldo_estoque"))
        if name == "stg_vendas__itens_pedido":
            # The one source with several versions per key.
            entry = TABLES_BY_NAME["vendas.itens_pedido"]
            return latest_per_key(self.source(entry.full_name), entry.natural_key, ("updated_at", "_ingested_at"))
        if name.startswith("stg_"):
            return self.source(name.removeprefix("stg_").replace("__", "."))
        builders = {
            "int_vendas__pedidos_unificados": silver.build_orders,
            "int_clientes__unificados": silver.build_customers,
            "int_produtos__catalogo": silver.build_catalog,
            "fato_orcamento": facts.build_budget,
            "fato_venda__by_natural": facts.sales_by_natural,
            "fato_estoque__by_natural": facts.stock_by_natural,
            **DIMENSIONS,
            **{n: m.build for n, m in INCREMENTAL.items()},
        }
        if name == "dim_tempo":
            return dims.build_calendar(self.spark, self.cfg)
        if name == "dim_canal_venda":
            return dims.build_channel(self.spark)
        return builders[name](self, self.cfg)


