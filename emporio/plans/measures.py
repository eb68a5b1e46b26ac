"""The measure layer: named aggregates over the star.

A measure is an aggregate expression on one table; :func:`evaluate` computes any
number of them in one aggregation per table and lines the results up on the
grouping columns.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporio.functions.calendar import month_start
from emporio.functions.keys import NO_CAMPAIGN
from emporio.functions.numeric import count_if_distinct, safe_divide, sum_if
from emporio.operators.periods import period_shift, period_shifts
from emporio.operators.ranking import dense_rank_by, share_of_total
from emporio.plans.facts import found_surrogate
from emporio.plans.star import Star


@dataclass(frozen=True)
class Context:
    """What a measure may depend on: "today", the selected period, and the columns its groups are made by."""

    as_of: date = date(2026, 7, 20)
    start: date = date(2023, 7, 21)
    end: date = date(2026, 7, 20)
    grouped_by: tuple[str, ...] = ()

    def days_back(self, n: int) -> Column:
        return F.lit(self.as_of - timedelta(days=n))


@dataclass(frozen=True)
class Measure:
    table: str
    expression: Callable[[Context], Column]


@dataclass(frozen=True)
class Derived:
    """Computed from other measures after they are lined up."""

    parts: tuple[str, ...]
    combine: Callable[..., Column]


def mean(value: Column) -> Column:
    """Average of the non-NULL values as double, from exact sum and count."""
    return safe_divide(F.sum(value), F.count(value))


_c = F.col


# Functions, not columns: a column can only be made once a session exists.
def _net() -> Column:
    return _c("valor_liquido_item")


def _qty() -> Column:
    return _c("qtd_vendida")


def _gross() -> Column:
    return _c("preco_unitario") * _qty()


def _order() -> Column:
    return _c("id_pedido_dg")


def _orders() -> Column:
    return F.count_distinct(_order())


def _stock() -> Column:
    return _c("qtd_disponivel")


def _any_row() -> Column:
    return F.lit(True)


def _unpaid() -> Column:
    return ~_c("fl_pago")


def _sales(expression: Callable[[Context], Column]) -> Measure:
    return Measure("fato_venda", expression)


def _last_30_days(ctx: Context) -> Column:
    return _c("dt_pedido_data").between(ctx.days_back(29), F.lit(ctx.as_of))


def _share(condition: Column, base: Column) -> Column:
    return safe_divide(F.count_if(condition), F.count_if(base))


def _members(ctx: Context, who: str, condition: Column | None = None) -> Column:
    """Distinct values of ``who`` on rows where ``condition`` holds.

    A group made by ``who`` has one value at most, which a flag tells: several distinct counts in one aggregation cost
    an Expand, which sends every row once per count.
    """
    if who not in ctx.grouped_by:
        return F.count_distinct(who) if condition is None else count_if_distinct(condition, _c(who))
    counts = _c(who).isNotNull() if condition is None else condition & _c(who).isNotNull()
    return F.max(F.when(counts, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long")))


MEASURES: dict[str, Measure | Derived] = {
    # Sales
    "receita_bruta": _sales(lambda ctx: sum_if(~_c("fl_cancelado"), _gross())),
    "receita_liquida": _sales(lambda ctx: F.sum(_net())),
    "receita_liquida_valida": _sales(lambda ctx: sum_if(_c("fl_venda_valida"), _net())),
    "total_pedidos": _sales(lambda ctx: _orders()),
    "ticket_medio": _sales(lambda ctx: safe_divide(F.sum(_net()), _orders())),
    "unidades_vendidas": _sales(lambda ctx: F.sum(_qty())),
    "taxa_desconto": _sales(lambda ctx: safe_divide(F.sum("desconto_item"), F.sum(_gross()))),
    "taxa_devolucao": _sales(lambda ctx: safe_divide(count_if_distinct(_c("fl_devolvido"), _order()), _orders())),
    "margem_bruta_valor": _sales(lambda ctx: F.sum("margem_bruta_item")),
    "margem_bruta_pct": _sales(lambda ctx: safe_divide(F.sum("margem_bruta_item"), F.sum(_net()))),
    "cmv": _sales(lambda ctx: F.sum(_qty() * _c("custo_unitario"))),
    # Freight is an order value repeated on every item; see freight_share_by_order for the other reading.
    "frete_pct_receita": _sales(lambda ctx: safe_divide(F.sum("valor_frete_pedido"), F.sum(_net()))),
    "receita_atribuida": _sales(lambda ctx: sum_if(_c("sk_campanha") != NO_CAMPAIGN, _net())),
    # Literal reading: the key is never blank, so this keeps every sale.
    "receita_atribuida_literal": _sales(lambda ctx: sum_if(_c("sk_campanha").isNotNull(), _net())),
    "clientes_ativos_90d": _sales(
        lambda ctx: count_if_distinct(
            _c("fl_venda_valida") & (_c("dt_pedido_data") >= ctx.days_back(90)), _c("sk_cliente")
        )
    ),
    "venda_media_diaria_30d": _sales(lambda ctx: safe_divide(sum_if(_last_30_days(ctx), _qty()), F.lit(30))),
    # Customers
    "clientes": Measure("dim_cliente", lambda ctx: F.count_distinct("sk_cliente")),
    "ltv_medio": Measure("dim_cliente", lambda ctx: mean(_c("ltv"))),
    "saldo_pontos": Measure("dim_cliente", lambda ctx: F.sum("saldo_techpoints")),
    "novos_clientes": Measure(
        "dim_cliente",
        lambda ctx: count_if_distinct(
            _c("primeira_compra").between(F.lit(ctx.start), F.lit(ctx.end)), _c("sk_cliente")
        ),
    ),
    # Stock
    "estoque_medio": Measure("fato_estoque", lambda ctx: mean(_stock())),
    "ultimo_estoque": Measure(
        "fato_estoque",
        # On the newest day with a balance; the larger balance when a day has several.
        lambda ctx: F.max(F.when(_stock().isNotNull(), F.struct("sk_tempo", "qtd_disponivel")))["qtd_disponivel"],
    ),
    "taxa_ruptura": Measure(
        "fato_estoque",
        lambda ctx: safe_divide(_members(ctx, "sk_produto", _c("fl_ruptura")), _members(ctx, "sk_produto")),
    ),
    # Logistics
    "otd_pct": Measure("fato_entrega", lambda ctx: _share(_c("fl_sla_atendido"), _any_row())),
    "otd_entregues_pct": Measure(
        "fato_entrega", lambda ctx: _share(_c("fl_sla_atendido"), _c("fl_entregue"))
    ),
    "lead_time_medio": Measure("fato_entrega", lambda ctx: mean(_c("lead_time_real_dias"))),
    "atraso_medio": Measure("fato_entrega", lambda ctx: mean(F.when(~_c("fl_sla_atendido"), _c("atraso_dias")))),
    "pedidos_abertos": Measure("fato_entrega", lambda ctx: F.count_if(~_c("fl_entregue"))),
    # Finance
    "receita_bruta_ff": Measure("fato_financeiro", lambda ctx: sum_if(_c("tipo") == "receita", _c("valor"))),
    "valor_lancado": Measure("fato_financeiro", lambda ctx: F.sum("valor")),
    "cr_vencer": Measure(
        "fato_financeiro", lambda ctx: sum_if(_unpaid() & (_c("dt_pagamento") >= F.lit(ctx.as_of)), _c("valor"))
    ),
    "cr_vencido": Measure(
        "fato_financeiro", lambda ctx: sum_if(_unpaid() & (_c("dt_pagamento") < F.lit(ctx.as_of)), _c("valor"))
    ),
    "budget_receita": Measure("fato_orcamento", lambda ctx: F.sum("valor_meta_receita")),
    "realizado_receita": Measure("fato_orcamento", lambda ctx: F.sum("receita_realizada")),
    "atingimento_meta": Measure(
        "fato_orcamento", lambda ctx: safe_divide(F.sum("receita_realizada"), F.sum("valor_meta_receita"))
    ),
    # A sum of percentages, as documented; variacao_receita_pct is the weighted form.
    "variacao_receita_soma": Measure("fato_orcamento", lambda ctx: F.sum("var_receita_pct")),
    "variacao_receita_pct": Measure(
        "fato_orcamento",
        lambda ctx: safe_divide(F.sum(_c("receita_realizada") - _c("valor_meta_receita")), F.sum("valor_meta_receita")),
    ),
    # Web and marketing
    "sessoes": Measure("fato_cliente_interacao", lambda ctx: F.count("sk_sessao")),
    "taxa_conversao": Measure("fato_cliente_interacao", lambda ctx: _share(_c("converteu"), _any_row())),
    "taxa_abandono_carrinho": Measure(
        "fato_cliente_interacao", lambda ctx: _share(_c("fl_abandono_carrinho"), _c("qtd_add_cart") > 0)
    ),
    "investimento_campanha": Measure("dim_campanha", lambda ctx: F.sum("orcamento")),
    # Over two tables
    "giro_estoque": Derived(("unidades_vendidas", "estoque_medio"), safe_divide),
    "dias_cobertura": Derived(("ultimo_estoque", "venda_media_diaria_30d"), safe_divide),
    "roi_campanha": Derived(
        ("receita_atribuida", "investimento_campanha"),
        lambda revenue, spend: safe_divide(F.coalesce(revenue, F.lit(0)) - spend, spend),
    ),
}
MEASURES["margem_produto_pct"] = MEASURES["margem_bruta_pct"]
MEASURES["clientes_ativos"] = MEASURES["clientes"]


def _expand(names: Sequence[str]) -> list[str]:
    base: list[str] = []
    for name in names:
        found = MEASURES[name]
        base += found.parts if isinstance(found, Derived) else [name]
    return list(dict.fromkeys(base))


def evaluate(
    star: Star,
    names: Sequence[str],
    group_by: Sequence[str] = (),
    where: Column | None = None,
    using: Sequence[str] = (),
    context: Context | None = None,
) -> DataFrame:
    """Values of the measures per group.

    ``group_by`` and ``using`` name columns as ``dimension.column``, or plainly
    when every table involved has them; ``where`` filters each table and may
    refer to the ``using`` columns.  Groups absent from one table give NULL for
    its measures.
    """
    ctx = replace(context or Context(), grouped_by=tuple(group_by))
    by_table: dict[str, list[str]] = {}
    for name in _expand(names):
        by_table.setdefault(MEASURES[name].table, []).append(name)
    keys = [g.split(".")[-1] for g in group_by]

    result: DataFrame | None = None
    for table, measures in by_table.items():
        # A surrogate key is made of what each group comes to: its 32 letters would travel with every part of a sum.
        wide, found = star.by_natural(table, group_by)
        df = wide.flat(table, [*group_by, *using])
        if table.startswith("dim_") and "fl_current" in df.columns:
            df = df.filter("fl_current")
        if where is not None:
            df = df.filter(where)
        groups = [F.col(found[g]) if g in found else c for g, c in zip(group_by, star.grouping(table, group_by))]
        values = df.groupBy(*groups).agg(*[MEASURES[m].expression(ctx).alias(m) for m in measures])
        if found:
            values = values.select(*[found_surrogate(g) if g in found else k for g, k in zip(group_by, keys)], *measures)
        result = values if result is None else _line_up(result, values, keys, measures)
    return result.select(*keys, *[_output(name).alias(name) for name in names])


def _output(name: str) -> Column:
    found = MEASURES[name]
    return found.combine(*map(F.col, found.parts)) if isinstance(found, Derived) else F.col(name)


def _line_up(left: DataFrame, right: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    if not keys:
        # Both sides are one row: attach the values as scalars.
        return left.select("*", *[right.select(m).scalar().alias(m) for m in measures])
    other = right.select(*[F.col(k).alias(f"__{k}") for k in keys], *measures)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    joined = left.join(other, same, "full_outer")
    kept = [c for c in left.columns if c not in keys]
    return joined.select(*[F.coalesce(k, f"__{k}").alias(k) for k in keys], *kept, *measures)


def measure(name: str) -> Callable[..., DataFrame]:
    """The measure as a function ``(star, group_by=(), where=None, as_of=None)``."""
    if name not in MEASURES:
        raise KeyError(f"unknown measure {name!r}; known: {sorted(MEASURES)}")

    def run(star: Star, group_by: Sequence[str] = (), where: Column | None = None, as_of: date | None = None,
            using: Sequence[str] = ()) -> DataFrame:
        ctx = Context() if as_of is None else replace(Context(), as_of=as_of)
        return evaluate(star, [name], group_by, where, using, ctx)

    return run


def mix(star: Star, by: str, name: str = "receita_liquida", out: str = "mix_pct") -> DataFrame:
    """Each group's share of the whole."""
    return share_of_total(evaluate(star, [name], [by]), name, out)


def sales_by_period(star: Star, grain: str, name: str = "receita_liquida") -> DataFrame:
    """The measure per ``day`` or per month, dated by the month's first day."""
    sales = star["fato_venda"]
    period = F.col("dt_pedido_data") if grain == "day" else month_start(F.col("dt_pedido_data"))
    dated = star.replacing("fato_venda", sales.withColumn("periodo", period))
    return evaluate(dated, [name], ["periodo"])


def year_over_year(star: Star, name: str = "receita_liquida") -> DataFrame:
    """Per month, the value one year and one month before."""
    monthly = sales_by_period(star, "month", name)
    return period_shifts(monthly, "periodo", name, {"ano_anterior": (12, 0), "mes_anterior": (1, 0)})


def week_over_week(star: Star, name: str = "receita_liquida") -> DataFrame:
    """Per day, the value seven days before."""
    return period_shift(sales_by_period(star, "day", name), "periodo", name, "semana_anterior", days=7)


def store_ranking(star: Star) -> DataFrame:
    """Dense rank of stores by net revenue."""
    revenue = evaluate(star, ["receita_liquida"], ["dim_loja.nome_loja"])
    return dense_rank_by(revenue, "receita_liquida", "rank_loja")


def freight_share_by_order(star: Star, group_by: Sequence[str] = ()) -> DataFrame:
    """Freight over net revenue with each order's freight counted once."""
    df = star.flat("fato_venda", group_by)
    groups = star.grouping("fato_venda", group_by)
    keys = [g.split(".")[-1] for g in group_by]
    orders = df.groupBy(*groups, _order().alias("__order")).agg(
        F.max("valor_frete_pedido").alias("frete"), F.sum(_net()).alias("receita")
    )
    return orders.groupBy(*keys).agg(safe_divide(F.sum("frete"), F.sum("receita")).alias("frete_pct_receita_pedido"))


def ledger_by_month(star: Star, date_role: str = "dt_competencia") -> DataFrame:
    """Ledger value per month of the chosen date role, accrual by default."""
    month = month_start(F.col(date_role))
    ledger = star["fato_financeiro"].withColumn("periodo", month)
    return evaluate(star.replacing("fato_financeiro", ledger), ["valor_lancado"], ["periodo"])
