"""Building the whole warehouse, from nothing or from what changed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emporio.config import WarehouseConfig
from emporio.operators.incremental import high_water, last_days
from emporio.operators.scd2 import scd2_apply
from emporio.plans import dimensions as dims
from emporio.plans import facts, silver
from emporio.plans.aggregates import MaintainedSums
from emporio.plans.staging import refresh_staging
from emporio.plans.versions import VersionLink, VersionLinks
from emporio.registry import TABLES, TABLES_BY_NAME, TableEntry
from emporio.sinks.export import run_all
from emporio.sinks.tables import Warehouse, month_partition
from emporio.sources.bronze import read_bronze
from emporio.sources.reference import read_seed

INGESTED = "_ingested_at"


@dataclass(frozen=True)
class Incremental:
    """How a model is refreshed.

    ``key`` joins the driving input to the others in ``inputs``; a change in any
    of them rebuilds the rows of that key.  ``lookups`` are dimensions by the
    input and column that name their rows, where needed with the input's row id
    and its column in the fact: a dimension row that comes after the fact
    rebuilds the rows of the key that still miss it, found in the stored fact by
    ``stored_key`` or by that id.  ``row`` is the same pair for the driver, whose
    rows may have no key.
    """

    build: Callable[[dict[str, DataFrame], WarehouseConfig], DataFrame]
    unique_key: str
    driver: str
    inputs: tuple[str, ...]
    key: tuple[str, ...]
    day: str
    stored_key: tuple[str, ...] = ()
    lookups: tuple[tuple, ...] = ()
    row: tuple[str, str] | None = None


# Rebuilt by affected key; the rest is small or depends on the anchor date and is rebuilt whole.
INCREMENTAL: dict[str, Incremental] = {
    "int_vendas__pedidos_unificados": Incremental(
        silver.build_orders, "id_pedido", "stg_vendas__pedidos",
        ("stg_vendas__itens_pedido", "stg_vendas__devolucoes"), ("id_pedido",), "dt_pedido_data",
    ),
    "fato_venda": Incremental(
        facts.build_sales, "sk_venda", "int_vendas__pedidos_unificados",
        ("stg_vendas__itens_pedido", "stg_vendas__devolucoes", "stg_rh__comissoes"), ("id_pedido",), "dt_pedido_data",
        ("id_pedido_dg",),
        (
            ("int_vendas__pedidos_unificados", "id_cliente", "dim_cliente"),
            ("int_vendas__pedidos_unificados", "id_loja", "dim_loja"),
            ("int_vendas__pedidos_unificados", "id_campanha", "dim_campanha"),
            ("stg_vendas__itens_pedido", "id_produto", "dim_produto", ("id_item_pedido", "id_item_pedido_dg")),
        ),
    ),
    "fato_estoque": Incremental(
        facts.build_stock, "sk_estoque", "stg_estoque__saldo_estoque",
        ("stg_estoque__movimentacoes",), ("id_produto", "id_loja"), "dt_ultima_atualizacao",
        ("id_produto_nk", "id_loja_nk"),
        (
            ("stg_estoque__saldo_estoque", "id_produto", "dim_produto"),
            ("stg_estoque__saldo_estoque", "id_loja", "dim_loja"),
        ),
    ),
    "fato_entrega": Incremental(
        facts.build_delivery, "sk_entrega", "stg_logistica__entregas",
        ("stg_vendas__pedidos",), ("id_pedido",), "dt_postagem",
        ("id_pedido_dg",),
        (
            ("stg_vendas__pedidos", "id_cliente", "dim_cliente"),
            ("stg_logistica__entregas", "id_loja_origem", "dim_loja"),
            ("stg_logistica__entregas", "id_transportadora", "dim_transportadora"),
            ("stg_logistica__entregas", "id_modalidade", "dim_modalidade_entrega"),
        ),
        ("id_entrega", "id_entrega_dg"),
    ),
    "fato_financeiro": Incremental(
        facts.build_ledger, "sk_lancamento", "stg_financeiro__lancamentos",
        ("stg_financeiro__contas_receber",), ("id_pedido",), "dt_competencia",
        ("id_pedido_dg",), (("stg_financeiro__lancamentos", "id_loja", "dim_loja"),), ("id_lancamento", "id_lancamento_dg"),
    ),
    "fato_cliente_interacao": Incremental(
        facts.build_sessions, "sk_sessao", "stg_web_analytics__sessoes",
        ("stg_web_analytics__eventos_carrinho",), ("id_sessao",), "dt_sessao",
        ("id_sessao_dg",), (("stg_web_analytics__sessoes", "id_cliente", "dim_cliente"),),
    ),
}

DIMENSIONS: dict[str, Callable[[dict[str, DataFrame], WarehouseConfig], DataFrame]] = {
    "dim_cliente": dims.build_customer,
    "dim_produto": dims.build_product,
    "dim_loja": dims.build_store,
    "dim_vendedor": dims.build_seller,
    "dim_campanha": dims.build_campaign,
    "dim_transportadora": dims.build_carrier,
    "dim_fornecedor": dims.build_supplier,
    "dim_modalidade_entrega": dims.build_delivery_mode,
}


# Version keys of each sale, kept beside the fact where dimensions keep their versions.
SALES_VERSIONS = "fato_venda_versoes"
SALES_LINKS = [
    VersionLink("dim_cliente", "sk_cliente", "sk_cliente", "sk_cliente_versao"),
    VersionLink("dim_produto", "sk_produto", "sk_produto", "sk_produto_versao"),
    VersionLink("dim_loja", "sk_loja", "sk_loja", "sk_loja_versao"),
    VersionLink("dim_campanha", "sk_campanha", "sk_campanha", "sk_campanha_versao", facts.NO_CAMPAIGN),
]


def restrict(
    dfs: dict[str, DataFrame], model: Incremental, marks: dict[str, datetime], stored: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Inputs reduced to the keys with news in any input since its mark, or with a dimension row come late.

    New driving rows are kept even when their key is NULL.
    """
    names = (model.driver, *model.inputs)
    key = list(model.key)
    fresh = {n: F.col(INGESTED) > F.lit(marks[n]) if n in marks else F.lit(True) for n in names}
    late = [] if stored is None else [late_rows(dfs, model, stored, look) for look in model.lookups]
    changed = reduce(DataFrame.union, [dfs[n].filter(fresh[n]).select(*key) for n in names] + [df.select(*key) for df in late])
    changed = changed.distinct()
    out = {n: dfs[n].join(changed, key, "left_semi") for n in model.inputs}
    driver = dfs[model.driver]
    keyless = driver.filter(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key]))
    kept = driver.join(changed, key, "left_semi").unionByName(keyless.filter(fresh[model.driver]))
    rows = [df.select(model.row[0]) for df in late if model.row and model.row[0] in df.columns]
    if rows:
        own = keyless.filter(~fresh[model.driver]).join(reduce(DataFrame.union, rows).distinct(), model.row[0], "left_semi")
        kept = kept.unionByName(own)
    out[model.driver] = kept
    return {**dfs, **out}


def late_rows(dfs: dict[str, DataFrame], model: Incremental, stored: DataFrame, lookup: tuple) -> DataFrame:
    """Keys (and driver rows) of the input of ``lookup`` whose stored fact misses a dimension row that is there now."""
    name, column, dim = lookup[:3]
    natural, surrogate, _ = facts.DIMENSION_KEYS[dim]
    current = dfs[dim].filter("fl_current") if "fl_current" in dfs[dim].columns else dfs[dim]
    known = current.select(F.col(natural).alias(column)).distinct()
    missing = stored.filter(F.col(surrogate).isin(*facts.MISSES))
    row = lookup[3] if len(lookup) > 3 else model.row if name == model.driver else None
    keys = list(zip(model.stored_key, model.key))
    wanted = dfs[name].filter(F.col(column).isNotNull()).join(known, column, "left_semi")
    if row:
        ids = missing.select(F.col(row[1]).alias(row[0])).distinct()
        return wanted.join(ids, row[0], "left_semi").select(*model.key, *([row[0]] if name == model.driver else []))
    unresolved = missing.select(*[F.col(s).alias(k) for s, k in keys]).distinct()
    return wanted.join(unresolved, list(model.key), "left_semi").select(*model.key)


def newest_ingestion(frames: dict[str, DataFrame]) -> dict[str, datetime]:
    """Largest ingestion time of each input that has rows."""
    marks = {n: high_water(df.select(F.unix_micros(INGESTED).alias("at")), "at") for n, df in frames.items()}
    return {n: datetime.fromtimestamp(m / 1_000_000, tz=timezone.utc) for n, m in marks.items() if m is not None}


def build_all(dfs: dict[str, DataFrame], spark: SparkSession, cfg: WarehouseConfig) -> dict[str, DataFrame]:
    """Every model as one lazy plan over staged inputs, nothing stored."""
    out = dict(dfs)
    out["int_vendas__pedidos_unificados"] = silver.build_orders(out, cfg)
    out["int_clientes__unificados"] = silver.build_customers(out, cfg)
    out["int_produtos__catalogo"] = silver.build_catalog(out, cfg)
    out["dim_tempo"] = dims.build_calendar(spark, cfg)
    out["dim_canal_venda"] = dims.build_channel(spark)
    for name, build in DIMENSIONS.items():
        out[name] = build(out, cfg)
    for name, model in INCREMENTAL.items():
        if name.startswith("fato_"):
            out[name] = model.build(out, cfg)
    out["fato_orcamento"] = facts.build_budget(out, cfg)
    return out


class Transform:
    """Stored warehouse: staging, intermediates, dimensions, facts, in that order."""

    def __init__(self, spark: SparkSession, cfg: WarehouseConfig, parallel: int = 8):
        self.spark, self.cfg, self.parallel = spark, cfg, parallel
        self.warehouse = Warehouse(spark, cfg.warehouse_root)
        self.frames: dict[str, DataFrame] = {}

    def run(self) -> dict[str, DataFrame]:
        """Refresh every model; returns the stored tables by name."""
        cfg, w = self.cfg, self.warehouse

        def stage(entry: TableEntry) -> None:
            self.frames[entry.staging_name] = refresh_staging(self.spark, entry, cfg.bronze_root, w, cfg.full_refresh)

        seed = read_seed(self.spark, cfg.holiday_seed) if cfg.holiday_seed else None
        self._together({e.staging_name: partial(stage, e) for e in TABLES})
        self._together(
            {
                "orders": lambda: self._refresh("int_vendas__pedidos_unificados"),
                "customers": lambda: self._store("int_clientes__unificados", silver.build_customers(self.frames, cfg)),
                "catalog": lambda: self._store("int_produtos__catalogo", silver.build_catalog(self.frames, cfg)),
                "calendar": lambda: self._store("dim_tempo", dims.build_calendar(self.spark, cfg, seed)),
                "channels": lambda: self._store("dim_canal_venda", dims.build_channel(self.spark)),
            }
        )
        self._together(
            {n: (lambda n=n, b=b: self._store_dimension(n, b(self.frames, cfg))) for n, b in DIMENSIONS.items()}
        )
        self._together({n: partial(self._refresh, n) for n in INCREMENTAL if n.startswith("fato_")})
        # Budgets compare with all sales of their month: the sums of a month follow the changed sales, the few budgets are rebuilt.
        sums = MaintainedSums(self.warehouse, facts.sales_by_month())
        kept = {sums.spec.name: sums.refresh(cfg.full_refresh)}
        self._store("fato_orcamento", facts.build_budget({**self.frames, **kept}, cfg))
        if cfg.keep_versions:
            self.frames[SALES_VERSIONS] = VersionLinks(self.warehouse, SALES_VERSIONS, "sk_venda", "dt_pedido_data", SALES_LINKS).follow("fato_venda")
        return self.frames

    def _together(self, tasks: dict[str, Callable[[], object]]) -> None:
        """Run the independent steps of a layer side by side; all finish before a failure is raised."""
        failed = [r for r in run_all(tasks, self.parallel) if not r.ok]
        if failed:
            raise RuntimeError("; ".join(f"{r.name}: {r.error}" for r in failed))

    def _store(self, name: str, df: DataFrame) -> None:
        self.frames[name] = self.warehouse.overwrite(df, name)

    def _store_dimension(self, name: str, df: DataFrame) -> None:
        before = self.warehouse.read_or_none(name) if self.cfg.keep_versions and not self.cfg.full_refresh else None
        if before is None or name not in dims.VERSIONED:
            return self._store(name, df)
        key, tracked = dims.VERSIONED[name]
        source = df.drop("valid_from", "valid_to", "fl_current", "hash_row")
        self._store(name, scd2_apply(before, source, key, tracked, self.cfg.today))

    def _inputs(self, name: str, model: Incremental, frames: dict[str, DataFrame], marks: dict[str, datetime]) -> dict[str, DataFrame]:
        """Inputs of a model for this run: everything, the affected keys, or a date window."""
        if not marks:
            return frames
        if name == "fato_venda" and self.cfg.sales_window_days is not None:
            newest = high_water(self.warehouse.read(name), model.day)
            return {**frames, model.driver: last_days(frames[model.driver], model.day, newest, self.cfg.sales_window_days)}
        return restrict(frames, model, marks, self.warehouse.read_or_none(name))

    def _stock_history(self) -> DataFrame:
        entry = TABLES_BY_NAME["estoque.saldo_estoque"]
        return facts.stock_snapshots(read_bronze(self.spark, entry, self.cfg.bronze_root)).select(
            *entry.staging_schema.names
        )

    def _refresh(self, name: str) -> None:
        model = INCREMENTAL[name]
        frames = dict(self.frames)
        if name == "fato_estoque":
            # Staging has the last balance of a product and store; the fact has one per day, so it starts from all versions.
            frames[model.driver] = self._stock_history()
        marks = {} if self.cfg.full_refresh else self.warehouse.marks(name)
        batch = model.build(self._inputs(name, model, frames, marks), self.cfg)
        day: Column = F.col(model.day)
        self.frames[name] = self.warehouse.upsert(
            batch,
            name,
            [model.unique_key],
            partition=month_partition(day),
            full_refresh=self.cfg.full_refresh or not marks,
            marks=newest_ingestion({n: frames[n] for n in (model.driver, *model.inputs)}),
            images=name == "fato_venda",
        )
