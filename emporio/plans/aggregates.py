"""Sums kept up to date from the images of changed rows.

A table of sums per group is not built again when its fact changes: every changed row is taken off the group it was in
and added to the group it is in now.  A distinct count cannot be taken back from the changed rows alone, so the members
that changed are counted in the fact's touched months, which with the changes tells whether they were there before.

Each group remembers the commit of the fact up to which it holds.  A run that died between the swap of two partitions
and its commit is simply repeated: groups that have a commit already pass over it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporio.functions.keys import surrogate_key
from emporio.sinks.tables import Warehouse, micros

GROUP, ROWS, UNTIL = "__grupo", "__linhas", "__ate"


@dataclass(frozen=True)
class Sums:
    """Sums (NULL counting as zero) and distinct counts of a fact's rows that meet ``where``, per ``keys``.

    ``month`` gives a fact row's partition, and must be a function of the group; it is also how the fact is partitioned.
    """

    name: str
    fact: str
    keys: Mapping[str, Column]
    sums: Mapping[str, Column]
    month: Column
    where: Column
    distinct: Mapping[str, Column] = field(default_factory=dict)

    def _signed(self, rows: DataFrame) -> DataFrame:
        """Fact rows with a ``__sign`` as the columns that groups are made of."""
        return rows.filter(self.where).select(
            surrogate_key(*self.keys.values()).alias(GROUP), *[e.alias(k) for k, e in self.keys.items()],
            *[e.alias(n) for n, e in self.sums.items()], *[e.alias(n) for n, e in self.distinct.items()],
            self.month.alias("__month"), "__sign", *[c for c in (UNTIL,) if c in rows.columns],
        )

    def groups(self, fact: DataFrame) -> DataFrame:
        """All groups from all rows, nothing kept."""
        return self._grouped(fact, *self.keys)

    def whole(self, fact: DataFrame, until: int) -> DataFrame:
        """All groups as they are stored."""
        return self._grouped(fact, GROUP, *self.keys, "__month", rows=True).withColumn(UNTIL, F.lit(until))

    def _grouped(self, fact: DataFrame, *by: str, rows: bool = False) -> DataFrame:
        return self._signed(fact.withColumn("__sign", F.lit(1))).groupBy(*by).agg(
            *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in self.sums], *[F.count_distinct(n).alias(n) for n in self.distinct],
            *([F.count(F.lit(1)).alias(ROWS)] if rows else []),
        )

    def moved(self, images: Sequence[tuple[int, DataFrame]]) -> DataFrame:
        """Images by commit as rows that are taken off (sign -1) or added."""
        sided = [
            df.filter(F.col(side).isNotNull()).select(f"{side}.*", F.lit(sign).alias("__sign"), F.lit(at).cast("long").alias(UNTIL))
            for at, df in images for side, sign in (("before", -1), ("after", 1))
        ]
        return self._signed(reduce(DataFrame.unionByName, sided))

    def changed(self, moved: DataFrame, held: DataFrame, fact: DataFrame) -> DataFrame:
        """New state of the groups of ``moved``, from the stored groups ``held`` and the rows ``fact`` of their months now."""
        groups = moved.select(GROUP, *self.keys, "__month").distinct()
        stored = groups.join(held.drop(*self.keys, "__month"), GROUP, "left")
        # Only commits that a group does not have yet.
        had = held.select(GROUP, F.col(UNTIL).alias("__had"))
        news = moved.join(had, GROUP, "left").filter(F.col(UNTIL) > F.coalesce("__had", F.lit(-1)))
        signed = [F.sum(F.col(n) * F.col("__sign")).alias(f"__d_{n}") for n in self.sums]
        delta = news.groupBy(GROUP).agg(*signed, F.sum("__sign").alias("__d_rows"), F.max(UNTIL).alias("__new"))
        out = stored.join(delta, GROUP, "left")
        for n in self.distinct:
            out = out.join(self._members_gained(news, fact, n), GROUP, "left")
        zero = F.lit(0)

        def plus(name: str, change: str) -> Column:
            # A group may have been without rows before, or pass over all changes now.
            both = F.coalesce(F.col(name), zero) + F.coalesce(F.col(change), zero)
            return both.cast(held.schema[name].dataType).alias(name)

        return out.select(
            GROUP, *self.keys, "__month", *[plus(n, f"__d_{n}") for n in (*self.sums, *self.distinct)],
            plus(ROWS, "__d_rows"), F.coalesce("__new", UNTIL).alias(UNTIL),
        )

    def _members_gained(self, news: DataFrame, fact: DataFrame, name: str) -> DataFrame:
        """Change of a distinct count per group, from the members with changed rows only."""
        change = news.filter(F.col(name).isNotNull()).groupBy(GROUP, name).agg(F.sum("__sign").alias("__change"))
        now = self._signed(fact.withColumn("__sign", F.lit(1)))
        counted = now.join(change.select(GROUP, name), [GROUP, name], "left_semi").groupBy(GROUP, name).agg(F.count(F.lit(1)).alias("__now"))
        both = change.join(counted, [GROUP, name], "left").withColumn("__now", F.coalesce("__now", F.lit(0)))
        there, was = (F.col("__now") > 0).cast("int"), (F.col("__now") - F.col("__change") > 0).cast("int")
        return both.groupBy(GROUP).agg(F.sum(there - was).alias(f"__d_{name}"))


class MaintainedSums:
    """The stored table of :class:`Sums`."""

    def __init__(self, warehouse: Warehouse, spec: Sums):
        self.warehouse, self.spec = warehouse, spec

    def read(self) -> DataFrame:
        """Groups that have rows."""
        return self.warehouse.read(self.spec.name).filter(F.col(ROWS) > 0).drop(GROUP, "__month", ROWS, UNTIL)

    def refresh(self, full_refresh: bool = False) -> DataFrame:
        """Follow the fact's commits since the last refresh; start over after a rebuild of the fact."""
        w, spec = self.warehouse, self.spec
        newest, seen = w.last_commit(spec.fact), w.marks(spec.name).get(spec.fact)
        if seen == newest and not full_refresh:
            return self.read()
        images = None if full_refresh or seen is None or not w.exists(spec.name) else w.images_since(spec.fact, seen)
        month = F.col("__month")
        if images is None:
            w.overwrite(spec.whole(w.read(spec.fact), micros(newest)), spec.name, partition=month, marks={spec.fact: newest})
        else:
            w.upsert(self._changed(images), spec.name, [GROUP], partition=month, marks={spec.fact: newest})
        return self.read()

    def _changed(self, images) -> DataFrame:
        w, spec = self.warehouse, self.spec
        moved = spec.moved([(micros(at), df) for at, df in images])
        # One value per month directory that the batch touched.
        months = [r[0] for r in moved.select("__month").distinct().collect()]
        return spec.changed(moved, w.read_partitions(spec.name, months), w.read_partitions(spec.fact, months))
