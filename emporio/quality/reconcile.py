"""Gold against source: pairs of scalars compared with a tolerance (Q8, Q9).

The scalars asked of one table are one conditional aggregation of it, turned
into rows: each table is read once however many checks name it.  Their text is
plain SQL, so a database can be sent the same aggregation as a query and only
one row per table leaves it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# No deviation for counts and dates, 0.1 % for sums.
EXACT, DEFAULT_TOLERANCE = 0.0, 0.001
Frames = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Scalar:
    """``how`` (count, sum or max) of ``value`` over the rows of a table that meet ``where``.

    ``{since}`` in ``where`` is the first of the days looked at.  ``newest`` names
    a column: only rows with its largest value count.
    """

    table: str
    how: str = "count"
    value: str = "1"
    where: str | None = None
    newest: str | None = None

    def argument(self, as_of: date) -> str:
        since = f"DATE '{as_of - timedelta(days=2)}'"
        return f"CASE WHEN {self.where.format(since=since)} THEN {self.value} END" if self.where else self.value


@dataclass(frozen=True)
class Check:
    """A scalar from Gold and the one from the source it must equal; ``kind`` says how values are written as numbers."""

    name: str
    label: str
    gold: Scalar
    source: Scalar
    tolerance: float = DEFAULT_TOLERANCE
    kind: str = "number"


def deviation(gold: Column, source: Column) -> Column:
    """Relative difference; infinite when only one side has a value, zero when neither has."""
    g, s = gold.cast("double"), source.cast("double")
    infinite = F.lit(float("inf"))
    return (
        F.when(s.isNull() | (s == 0), F.when(g.isNull() | (g == 0), 0.0).otherwise(infinite))
        .when(g.isNull(), infinite)
        .otherwise(F.abs(g - s) / F.abs(s))
    )


def _two_days(name: str, label: str, gold: str, source: str, day: str, how="count", value="1", tolerance=EXACT, kind="number", source_day=None):
    """The same aggregate on both sides over the last two days."""
    sides = [Scalar(t, how, value, f"{d} >= {{since}}") for t, d in ((gold, day), (source, source_day or day))]
    return Check(name, label, *sides, tolerance, kind)


CHECKS: tuple[Check, ...] = (
    Check(
        "fato_venda.max_data", "newest valid order date (YYYYMMDD)",
        Scalar("fato_venda", "max", "dt_pedido_data", "fl_venda_valida"),
        Scalar("vendas.pedidos", "max", "CAST(dt_pedido AS DATE)", "status NOT IN ('cancelado', 'devolvido')"),
        EXACT, "day",
    ),
    Check(
        "fato_estoque.count", "rows of the newest snapshot",
        Scalar("fato_estoque", newest="sk_tempo"), Scalar("estoque.saldo_estoque", where="qtd_disponivel >= 0"), EXACT,
    ),
    _two_days("fato_entrega.count", "deliveries of two days", "fato_entrega", "logistica.entregas", "dt_postagem"),
    _two_days("fato_financeiro.count", "ledger entries of two days", "fato_financeiro", "financeiro.lancamentos", "dt_lancamento"),
    _two_days("fato_financeiro.valor", "ledger value of two days", "fato_financeiro", "financeiro.lancamentos", "dt_lancamento",
              "sum", "valor", DEFAULT_TOLERANCE, "money"),
    _two_days("fato_cliente_interacao.count_sessoes", "sessions of two days", "fato_cliente_interacao", "web_analytics.sessoes",
              "dt_sessao", source_day="CAST(dt_inicio AS DATE)"),
    Check("fato_orcamento.count", "budget rows", Scalar("fato_orcamento"), Scalar("financeiro.orcamentos"), EXACT),
    Check("fato_orcamento.receita_meta", "sum of revenue targets", Scalar("fato_orcamento", "sum", "valor_meta_receita"),
          Scalar("financeiro.orcamentos", "sum", "valor_meta_receita"), DEFAULT_TOLERANCE, "money"),
)


def select_checks(prefix: str | None = None, tolerance: float | None = None) -> list[Check]:
    """Checks whose name starts with ``prefix``; ``tolerance`` replaces that of every check, counts included."""
    chosen = [c for c in CHECKS if not prefix or c.name.startswith(prefix)]
    if not chosen:
        raise ValueError(f"no check named {prefix}*")
    return [replace(c, tolerance=tolerance) for c in chosen] if tolerance is not None else chosen


_TOTAL = {"count": "sum", "sum": "sum", "max": "max"}


def _one_scan(df: DataFrame, asked: Sequence[Scalar], as_of: date) -> DataFrame:
    """One row with a column per scalar.

    Where a scalar counts rows at a column's largest value, the table is first
    summed per value of that column, and the sums are merged.
    """
    by = next((s.newest for s in asked if s.newest), None)
    parts = [F.expr(f"{s.how}({s.argument(as_of)})").alias(f"s{i}") for i, s in enumerate(asked)]
    if by is None:
        return df.agg(*parts)

    def merged(i: int, s: Scalar) -> Column:
        return F.max_by(f"s{i}", by) if s.newest else F.expr(f"{_TOTAL[s.how]}(s{i})")

    # A count over no rows at all is 0 as well, not NULL.
    totals = [merged(i, s) for i, s in enumerate(asked)]
    counts = [F.coalesce(t, F.lit(0)) if s.how == "count" and not s.newest else t for t, s in zip(totals, asked)]
    return df.groupBy(by).agg(*parts).agg(*[c.alias(f"s{i}") for i, c in enumerate(counts)])


def _as_number(value: Column, kind: str) -> Column:
    if kind == "day":
        return F.date_format(value, "yyyyMMdd").cast("double")
    return (F.round(value, 2) if kind == "money" else value).cast("double")


def _unpivoted(row: DataFrame, checks: Sequence[Check], column: str) -> DataFrame:
    values = [F.struct(F.lit(c.name).alias("check"), _as_number(F.col(f"s{i}"), c.kind).alias(column)) for i, c in enumerate(checks)]
    return row.select(F.explode(F.array(*values)).alias("v")).select("v.*")


def _by_table(checks: Iterable[Check], side: str) -> dict[str, list[Check]]:
    tables: dict[str, list[Check]] = {}
    for c in checks:
        tables.setdefault(getattr(c, side).table, []).append(c)
    return tables


def scalars(frames: Frames, checks: Iterable[Check], side: str, as_of: date) -> DataFrame:
    """``(check, <side>_value)`` of all checks, reading each table once."""
    rows = [
        _unpivoted(_one_scan(frames[table], [getattr(c, side) for c in own], as_of), own, f"{side}_value")
        for table, own in _by_table(checks, side).items()
    ]
    return reduce(DataFrame.unionByName, rows)


def source_query(asked: Sequence[Scalar], as_of: date) -> str:
    """The aggregation of one table as the query that a database is sent."""
    parts = ", ".join(f"{s.how}({s.argument(as_of)}) AS s{i}" for i, s in enumerate(asked))
    return f"SELECT {parts} FROM {asked[0].table}"


def database_scalars(spark: SparkSession, options: Mapping[str, str], checks: Iterable[Check], as_of: date) -> DataFrame:
    """The source side computed by the database: one row per table comes back."""
    rows = []
    for own in _by_table(checks, "source").values():
        query = source_query([c.source for c in own], as_of)
        rows.append(_unpivoted(spark.read.format("jdbc").options(**options, query=query).load(), own, "source_value"))
    return reduce(DataFrame.unionByName, rows)


def judge(gold: DataFrame, source: DataFrame, checks: Iterable[Check], tolerance: float | None = None) -> DataFrame:
    """One row per check: both values, deviation, tolerance and verdict.  Both sides have a row per check."""
    sides = gold.withColumn("source_value", F.lit(None).cast("double")).unionByName(source.withColumn("gold_value", F.lit(None).cast("double")))
    both = sides.groupBy("check").agg(F.max("gold_value").alias("gold_value"), F.max("source_value").alias("source_value"))
    allowed = F.create_map(*[F.lit(x) for c in checks for x in (c.name, float(c.tolerance if tolerance is None else tolerance))])
    judged = both.withColumn("tolerance", allowed[F.col("check")]).withColumn("deviation", deviation(F.col("gold_value"), F.col("source_value")))
    return judged.withColumn("passed", F.col("deviation") <= F.col("tolerance"))


def reconcile(gold: Frames, source: Frames, as_of: date, checks: Iterable[Check] = CHECKS, tolerance: float | None = None) -> DataFrame:
    """:func:`judge` over frames of both sides."""
    checks = list(checks)
    return judge(scalars(gold, checks, "gold", as_of), scalars(source, checks, "source", as_of), checks, tolerance)
