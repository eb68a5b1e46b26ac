"""Registration of queries with their comparison SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.frames import Models, models
from catalog.source_views import GIVEN, VIEWS, view_name

Builder = Callable[[Models], DataFrame]

# Output types of a query: short letter -> (Spark type, DuckDB type).  Dates travel as ISO text.
_TYPES = {
    "s": ("string", "VARCHAR"),
    "l": ("bigint", "BIGINT"),
    "d": ("double", "DOUBLE"),
    "b": ("boolean", "BOOLEAN"),
}


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    columns: tuple[tuple[str, str], ...]
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(models(spark, sf_dir))
        return df.select(*[F.col(c).cast(_TYPES[t][0]).alias(c) for c, t in self.columns])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        casts = ", ".join(f'CAST("{c}" AS {_TYPES[t][1]}) AS "{c}"' for c, t in self.columns)
        return f"{with_clause(self.sql)}SELECT {casts} FROM ({self.sql}) q"


QUERIES: dict[str, Query] = {}
# Model name -> DuckDB SQL over source views and other models.
MODEL_SQL: dict[str, str] = {}


def query(name: str, columns: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    """Register a query; ``columns`` is ``"name:type ..."`` and fixes the output order."""

    def add(build: Builder) -> Builder:
        pairs = tuple(tuple(c.split(":")) for c in columns.split())
        QUERIES[name] = Query(name, build, pairs, sql)
        return build

    return add


def _definitions() -> dict[str, str]:
    names = {t: t for t in GIVEN}
    return {**{view_name(n): sql.format(**names) for n, sql in VIEWS.items()}, **MODEL_SQL}


def with_clause(sql: str) -> str:
    """WITH clause holding every model the SQL mentions, directly or not."""
    definitions = _definitions()
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b[a-z_]+\b", text):
            if name in definitions and name not in ordered:
                visit(definitions[name])
                if name not in ordered:
                    ordered.append(name)

    visit(sql)
    return "WITH " + ",\n".join(f"{n} AS ({definitions[n]})" for n in ordered) + "\n" if ordered else ""
