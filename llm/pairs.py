"""Comparing the members of groups with one another, in tasks of bounded size.

A group of ``n`` members is cut into ``ceil(n / block)`` blocks by a hash of the member; a task gets two blocks (or one)
and compares across them.  A member is sent once per block of its group, so a group of copies that holds a third of all
rows is spread over many tasks, and no task holds more than about two blocks.  Tasks return counts, and what they found
as stars around the smallest members, never the pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def streamed_groups(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], list[tuple]], schema: str) -> DataFrame:
    """``fn`` over each group of ``df``; many small groups share a task, which holds one group and one batch at a time."""
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}
    types = [kinds[c.split()[1]] for c in schema.split(", ")]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[pa.RecordBatch] = []  # of the last group so far
        last, rows = None, []

        def out() -> pa.RecordBatch:
            nonlocal rows
            columns = list(zip(*rows)) if rows else [()] * len(names)
            rows = []
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for batch in batches:
            if not len(batch):
                continue
            columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
            change = np.zeros(len(batch) - 1, bool)
            for c in columns:
                change |= c[1:] != c[:-1]
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(batch)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                key = tuple(c[a] for c in columns)
                if key != last and open_:
                    rows += fn(pa.Table.from_batches(open_))
                    open_ = []
                    if len(rows) > 10_000:
                        yield out()
                last = key
                open_.append(batch.slice(a, b - a))
        if open_:
            rows += fn(pa.Table.from_batches(open_))
        yield out()

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(stream, schema)


def block_tasks(members: DataFrame, group: str, member: str, block: int) -> DataFrame:
    """``members`` with ``bi <= bj`` and ``own``, a row for each task that needs them; groups of one are left out."""
    sizes = members.groupBy(group).agg(F.count("*").alias("n")).where("n > 1")
    return spread_blocks(members.join(sizes, group), member, block)


def spread_blocks(members: DataFrame, member: str, block: int) -> DataFrame:
    """The same for members that have the size ``n`` of their group."""
    placed = members.withColumn("_blocks", F.ceil(F.col("n") / block).cast("int"))
    placed = placed.withColumn("own", F.pmod(F.xxhash64(member), F.col("_blocks")).cast("int"))
    spread = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return spread.withColumn("bi", F.least("own", "_other")).withColumn("bj", F.greatest("own", "_other")).drop("n", "_blocks", "_other")


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, a: int) -> int:
        while self.up[a] != a:
            self.up[a] = self.up[self.up[a]]
            a = self.up[a]
        return a

    def union(self, a: int, b: int) -> None:
        x, y = self.find(a), self.find(b)
        if x != y:
            self.up[x] = y

    def stars(self, ids: list[int]) -> list[tuple[int, int]]:
        """Edges from the smallest id of each tree to its others; tasks that share members then return the same edges."""
        least: dict[int, int] = {}
        for k, i in enumerate(ids):
            root = self.find(k)
            least[root] = min(least.get(root, i), i)
        return [(low, i) for k, i in enumerate(ids) if (low := least[self.find(k)]) != i]


def sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Positions of a task's rows to compare: with one another if the task has one block, else one block with the other."""
    own, bi, bj = (table.column(c).to_numpy() for c in ("own", "bi", "bj"))
    return np.flatnonzero(own == bi[0]), np.flatnonzero(own == bj[0])
