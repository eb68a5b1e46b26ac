"""The star schema as a reader sees it: facts with their dimensions' attributes."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from emporio.plans.facts import FOUND_KEYS

# N:1 relationships, fact -> {dimension: (fact key, dimension key)}.
RELATIONSHIPS: dict[str, dict[str, tuple[str, str]]] = {
    "fato_venda": {
        "dim_cliente": ("sk_cliente", "sk_cliente"),
        "dim_produto": ("sk_produto", "sk_produto"),
        "dim_loja": ("sk_loja", "sk_loja"),
        "dim_tempo": ("sk_tempo", "sk_tempo"),
        "dim_canal_venda": ("sk_canal_venda", "sk_canal_venda"),
        "dim_campanha": ("sk_campanha", "sk_campanha"),
    },
    "fato_estoque": {
        "dim_produto": ("sk_produto", "sk_produto"),
        "dim_loja": ("sk_loja", "sk_loja"),
        "dim_tempo": ("sk_tempo", "sk_tempo"),
    },
    "fato_entrega": {
        "dim_cliente": ("sk_cliente", "sk_cliente"),
        "dim_loja": ("sk_loja", "sk_loja"),
        "dim_transportadora": ("sk_transportadora", "sk_transportadora"),
        "dim_modalidade_entrega": ("sk_modalidade_entrega", "sk_modalidade_entrega"),
        "dim_tempo": ("sk_tempo_postagem", "sk_tempo"),
    },
    "fato_financeiro": {
        "dim_loja": ("sk_loja", "sk_loja"),
        "dim_tempo": ("sk_tempo_competencia", "sk_tempo"),
    },
    "fato_cliente_interacao": {
        "dim_cliente": ("sk_cliente", "sk_cliente"),
        "dim_tempo": ("sk_tempo", "sk_tempo"),
    },
    "fato_orcamento": {
        "dim_loja": ("sk_loja", "sk_loja"),
        "dim_tempo": ("sk_tempo", "sk_tempo"),
    },
}


class Star:
    """Tables of the star, looked up by name."""

    def __init__(self, tables: Mapping[str, DataFrame]):
        self.tables = tables

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def replacing(self, name: str, df: DataFrame) -> Star:
        """The same star with one table exchanged."""
        return Star(ChainMap({name: df, f"{name}__by_natural": None}, self.tables))

    def by_natural(self, table: str, group_by: Sequence[str]) -> tuple[Star, dict[str, str]]:
        """The star in which ``table`` still has natural keys, where it does, and those that tell groups of ``group_by``.

        Of integral keys only: there no two have the same text, so none share a surrogate.
        """
        wide = self.tables.get(f"{table}__by_natural")
        if wide is None:
            return self, {}
        found = {g: FOUND_KEYS[g] for g in group_by if g in FOUND_KEYS and isinstance(wide.schema[FOUND_KEYS[g]].dataType, IntegralType)}
        return (self.replacing(table, wide), found) if found else (self, {})

    def _current(self, dim: str) -> DataFrame:
        df = self.tables[dim]
        return df.filter("fl_current") if "fl_current" in df.columns else df

    def flat(self, table: str, attributes: Sequence[str] = ()) -> DataFrame:
        """``table`` plus dimension attributes named ``dim.column``.

        Only dimensions that own a requested attribute are joined, with only
        the requested columns; plain names must be columns of the table itself.
        """
        df = self.tables[table]
        by_dim: dict[str, list[str]] = {}
        for name in attributes:
            dim, dot, column = name.partition(".")
            if dot and dim != table:
                by_dim.setdefault(dim, []).append(column)
        for dim, columns in by_dim.items():
            fact_key, dim_key = RELATIONSHIPS[table][dim]
            side = self._current(dim).select(
                F.col(dim_key).alias("__key"), *[F.col(c).alias(f"{dim}.{c}") for c in dict.fromkeys(columns)]
            )
            df = df.join(side, F.col(f"`{fact_key}`") == F.col("__key"), "left").drop("__key")
        return df

    def grouping(self, table: str, group_by: Sequence[str]) -> list[Column]:
        """Grouping columns, named without their dimension."""
        return [
            F.col(g.split(".")[-1] if g.startswith(f"{table}.") else f"`{g}`").alias(g.split(".")[-1])
            for g in group_by
        ]
