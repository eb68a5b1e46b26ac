"""Connected components of an edge table, by alternating large-star and small-star steps.

Every vertex ends with the smallest vertex of its component.  Each step keeps the components and moves edges towards
their smallest vertices; a star of a hot vertex is never gathered, only its minimum is, which combines before the
shuffle.  The number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import discard, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each vertex links its larger neighbours to the smallest of itself and its neighbours.  Edges have ``a < b``."""
    both = edges.select(F.col("a").alias("v"), F.col("b").alias("u")).unionByName(edges.select(F.col("b").alias("v"), F.col("a").alias("u")))
    lowest = both.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("m"))
    return both.where("u > v").join(lowest, "v").select(F.col("m").alias("a"), F.col("u").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each vertex links itself and its smaller neighbours to the smallest of them."""
    lowest = edges.groupBy("b").agg(F.min("a").alias("m"))
    others = edges.join(lowest, "b").where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return lowest.select(F.col("m").alias("a"), "b").unionByName(others).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(id, root)`` of every vertex of ``edges (a, b)`` that is not its own root; ``a`` and ``b`` are long, in any order."""
    now = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), name, release=True)
    seen = None
    while True:
        size = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if size == seen or not size[0]:
            return now.select(F.col("b").alias("id"), F.col("a").alias("root"))
        seen, before = size, now
        now = stored(_small_star(_large_star(before)), name)
        discard(before)
