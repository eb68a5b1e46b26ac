"""Stored facts at the version of their date.

Facts keep the key of an entity, which never changes.  Which version of the entity was in force on the fact's day does
change, when a correction comes with an earlier date.  So the version keys of a fact are a table beside it, partitioned
by month, and a refresh writes two kinds of rows: those of new or changed facts, and those on days that another version
has taken over.  Months without either are not touched.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporio.functions.keys import UNKNOWN
from emporio.operators.timeline import at_version, followed, moved_segments
from emporio.sinks.tables import Marks, Warehouse, micros, month_partition


@dataclass(frozen=True)
class VersionLink:
    """Column ``on`` of the fact names an entity of dimension ``dim`` (by its ``key``); ``alias`` gets the version."""

    dim: str
    on: str
    key: str
    alias: str
    default: str = UNKNOWN


class VersionLinks:
    """The table ``name`` of version keys of one fact: its ``row`` id, ``day``, entity columns and a key per link."""

    def __init__(self, warehouse: Warehouse, name: str, row: str, day: str, links: Sequence[VersionLink]):
        self.warehouse, self.name, self.row, self.day, self.links = warehouse, name, row, day, list(links)

    def link(self, fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
        """Version keys of facts, made anew."""
        entities = list(dict.fromkeys(x.on for x in self.links))
        rows = fact.select(self.row, self.day, *[c for c in entities if c not in (self.row, self.day)])
        return reduce(lambda df, x: at_version(df, dims[x.dim], x.on, x.key, self.day, x.alias, x.default), self.links, rows)

    def follow(self, fact: str) -> DataFrame:
        """Bring the stored links up to the stored ``fact`` and dimensions, from what both were when last looked at.

        The commits looked at are kept with the table, so a run that failed in between is made up for.  If the fact was
        rebuilt since, or a dimension's snapshot of then is gone, all links are made anew.
        """
        w, dims = self.warehouse, dict.fromkeys(x.dim for x in self.links)
        newest, seen = {n: w.last_commit(n) for n in (fact, *dims)}, w.marks(self.name)
        after = {n: w.read(n) for n in dims}
        known = w.exists(self.name) and set(newest) <= set(seen)
        images = w.images_since(fact, seen[fact]) if known else None
        before = {n: w.read_at(n, seen[n]) for n in dims} if known else {}
        if images is None or None in before.values():
            partition = month_partition(F.col(self.day))
            return w.overwrite(self.link(w.read(fact), after), self.name, partition=partition, marks=newest)
        changed = [df.filter("after IS NOT NULL").select("after", F.lit(micros(at)).alias("at")) for at, df in images]
        rows = w.read(fact).limit(0)
        if changed:
            last = reduce(DataFrame.union, changed).groupBy(F.col(f"after.{self.row}").alias("__id")).agg(F.max_by("after", "at").alias("row"))
            rows = last.select("row.*")
        moved = {n: df for n, df in before.items() if seen[n] != newest[n]}
        return self.refresh(rows, moved, after, newest)

    def refresh(
        self, batch: DataFrame, before: Mapping[str, DataFrame], after: Mapping[str, DataFrame], marks: Marks = None
    ) -> DataFrame:
        """Store the links of ``batch`` (new and changed facts) and follow the dimensions that changed.

        ``before`` has the dimensions that changed since the last refresh, as they were.
        """
        w, partition, rows = self.warehouse, month_partition(F.col(self.day)), self.link(batch, after)
        changed = [x for x in self.links if x.dim in before]
        if w.exists(self.name) and changed:
            segments = {x.alias: moved_segments(before[x.dim], after[x.dim], x.key) for x in changed}
            spans = [s.agg(F.min("from_day").alias("a")) for s in segments.values()]
            first = reduce(DataFrame.union, spans).agg(F.min("a")).first()[0]
            if first is not None:
                # Months before the first moved day are not opened; rows of the batch are linked anew already.
                new = batch.select(F.col(self.row).alias("__new"))
                stored = w.read_from(self.name, self.day, first).join(new, F.col(self.row) == F.col("__new"), "left_anti")
                moved = stored.withColumn("__hit", F.lit(False))
                for x in changed:
                    moved = followed(moved, segments[x.alias], x.on, x.key, self.day, x.alias, "__hit", x.default)
                rows = rows.unionByName(moved.filter("__hit").select(*rows.columns))
        return w.upsert(rows, self.name, [self.row], partition=partition, marks=marks)
