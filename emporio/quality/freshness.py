"""Freshness of Bronze and Gold, volume of the day's batches (Q5-Q7)."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emporio.functions.keys import date_key
from emporio.registry import TABLES_BY_NAME
from emporio.sinks.control import WatermarkLog
from emporio.sources.bronze import batch_rows, newest_file

# Bronze tables that must arrive daily.
CRITICAL_TABLES = ("vendas.pedidos", "vendas.itens_pedido", "clientes.clientes", "estoque.saldo_estoque",
                   "logistica.entregas", "financeiro.lancamentos", "web_analytics.sessoes")
# Date key by which a fact's age is judged; the other two facts are not judged.
FACT_DATE_KEYS = {
    "fato_venda": "sk_tempo",
    "fato_entrega": "sk_tempo_postagem",
    "fato_financeiro": "sk_tempo_competencia",
    "fato_cliente_interacao": "sk_tempo",
}
# Expected rows per day, least and most.
EXPECTED_ROWS = {
    "vendas.pedidos": (500, 20_000),
    "vendas.itens_pedido": (1_000, 60_000),
    "clientes.clientes": (0, 1_000),
    "estoque.saldo_estoque": (0, 10_000),
    "logistica.entregas": (200, 10_000),
    "financeiro.lancamentos": (500, 20_000),
    "web_analytics.sessoes": (1_000, 100_000),
    "web_analytics.eventos_carrinho": (500, 100_000),
}
TOLERANCE_HOURS = 26

RESULT = "check string, severity string, observed string, expected string, passed boolean"


def _as_utc(value: datetime | None) -> datetime | None:
    return value.astimezone(timezone.utc) if value is not None else None


def bronze_freshness(
    spark: SparkSession, root: str, now: datetime, hours: int = TOLERANCE_HOURS, tables=CRITICAL_TABLES
) -> DataFrame:
    """Each table was checked, or got a file, within the tolerance (Q5).

    The last extraction check counts first, since a table without news is
    fresh; otherwise the newest file does.
    """
    cutoff = now - timedelta(hours=hours)
    log = WatermarkLog(spark, root)
    states = {r["table"]: r for r in log.current().filter(F.col("table").isin(*tables)).collect()}
    rows = []
    for name in tables:
        state = states.get(name)
        seen = _as_utc(state and (state["last_checked_at"] or state["last_updated_at"]))
        if seen is None or seen < cutoff:
            seen = _as_utc(newest_file(spark, TABLES_BY_NAME[name], root))
        passed = seen is not None and seen >= cutoff
        rows.append((f"bronze:{name}", "error", str(seen), f">= {cutoff}", passed))
    return spark.createDataFrame(rows, RESULT)


def date_freshness(df: DataFrame, name: str, key: Column, least: Column) -> DataFrame:
    """One row: the largest ``key`` is at least ``least``; an empty table fails."""
    seen = df.agg(F.max(key).alias("seen"))
    return seen.select(
        F.lit(name).alias("check"),
        F.lit("error").alias("severity"),
        F.col("seen").cast("string").alias("observed"),
        F.concat(F.lit(">= "), least.cast("string")).alias("expected"),
        F.coalesce(F.col("seen") >= least, F.lit(False)).alias("passed"),
    )


def gold_freshness(facts: Mapping[str, DataFrame], now: datetime, hours: int = TOLERANCE_HOURS) -> DataFrame:
    """Newest date key per fact against the tolerance (Q6)."""
    least = date_key(F.lit((now - timedelta(hours=hours)).date()))
    out = None
    for name, column in FACT_DATE_KEYS.items():
        if name in facts:
            row = date_freshness(facts[name], f"gold:{name}", F.col(column), least)
            out = row if out is None else out.unionByName(row)
    return out


def volume_verdict(rows: Column, least: Column | int, most: Column | int) -> Column:
    """Where a row count stands to its range; a missing batch is below it."""
    return F.when(rows.isNull() | (rows < least), "abaixo").when(rows > most, "acima").otherwise("ok")


def check_volume(spark: SparkSession, root: str, day: date, expected=EXPECTED_ROWS) -> DataFrame:
    """Rows landed on ``day`` within their range (Q7); warnings only."""
    found = [(name, batch_rows(spark, TABLES_BY_NAME[name], root, day), *bounds) for name, bounds in expected.items()]
    rows = spark.createDataFrame(found, "name string, n long, least long, most long")
    return rows.select(
        F.concat(F.lit("batch:"), "name").alias("check"),
        F.lit("warning").alias("severity"),
        F.coalesce(F.col("n").cast("string"), F.lit("None")).alias("observed"),
        F.concat_ws("..", F.col("least").cast("string"), F.col("most").cast("string")).alias("expected"),
        (volume_verdict(F.col("n"), F.col("least"), F.col("most")) == "ok").alias("passed"),
    )


def check_freshness(
    spark: SparkSession,
    root: str,
    facts: Mapping[str, DataFrame],
    now: datetime,
    hours: int = TOLERANCE_HOURS,
    volume: bool = True,
) -> DataFrame:
    """All three checks, one row each; only rows of severity ``error`` should stop a run."""
    out = bronze_freshness(spark, root, now, hours)
    gold = gold_freshness(facts, now, hours)
    if gold is not None:
        out = out.unionByName(gold)
    return out.unionByName(check_volume(spark, root, now.date())) if volume else out
