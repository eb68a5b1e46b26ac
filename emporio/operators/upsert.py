"""Keyed replacement of rows and alignment of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporio.operators.dedup import latest_per_key


def align(df: DataFrame, columns: Sequence[str] | T.StructType) -> DataFrame:
    """Project to the target columns; missing ones become NULL, extra ones go (K8)."""
    if isinstance(columns, T.StructType):
        return df.select(
            *[
                (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in columns
            ]
        )
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in columns])


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union matching columns by name, absent ones NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def upsert(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None
) -> DataFrame:
    """Rows of ``batch`` replace rows of ``target`` with the same key.

    ``batch`` holds one row per key.  With ``order_by`` the winner is the newest
    version over both sides instead, so a re-delivered old row cannot overwrite
    a newer one.
    """
    if order_by is not None:
        merged = union_by_name(target, batch)
        return latest_per_key(merged, keys, order_by)
    keep = target.join(batch.select(*keys), list(keys), "left_anti")
    return union_by_name(keep.select(*target.columns), batch)
