"""Warehouse tables on plain Parquet.

A table is a directory of snapshots, ``<root>/<name>/snapshot=<n>``, and a log
of committed snapshot numbers.  A rebuild writes the next snapshot and then
appends its number to the log, so readers never see half a table and nothing
being read is overwritten.  Tables that grow without end are cut into
partitions instead and replace only those a batch touches: their new content is
written beside the table and swapped in partition by partition, so a reader may
meet some partitions before and some after such a batch.  Snapshots before the
last few, and what was written beside the table, are deleted after each commit.

A batch may also leave the images of the rows it changed, before and after, for
tables that are kept up to date from this one.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporio.operators.incremental import between
from emporio.operators.upsert import align, upsert
from emporio.sources.bronze import path_exists

LOG_SCHEMA = "snapshot long, query_id string, batch_id long, marks map<string,timestamp>, schema string, committed_at timestamp, images boolean"
KEPT_SNAPSHOTS = 3
KEPT_IMAGES = 10
PARTITION = "particao"


def month_partition(day: Column) -> Column:
    """Partition value of a date: ``yyyymm``, 0 when there is no date."""
    return F.coalesce(F.year(day) * 100 + F.month(day), F.lit(0))


def _by_partition(df: DataFrame) -> DataFrame:
    """Rows of a partition brought together for writing, so tasks do not each write a file per partition.

    A rebalance, not a repartition: a partition holding much of the table is
    split over several tasks, and small ones share a task.
    """
    return df.hint("rebalance", F.col(PARTITION))


def micros(at: datetime) -> int:
    since = at - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (since.days * 86_400 + since.seconds) * 1_000_000 + since.microseconds


def _time(micros: int) -> datetime:
    return datetime.fromtimestamp(micros // 1_000_000, tz=timezone.utc).replace(microsecond=micros % 1_000_000)


Marks = Mapping[str, datetime] | None
# Id of a streaming query and number of its batch.
StreamBatch = tuple[str, int] | None


class Warehouse:
    """Named tables under one root, each written by one job at a time."""

    def __init__(self, spark: SparkSession, root: str, kept_snapshots: int = KEPT_SNAPSHOTS):
        self.spark, self.kept_snapshots = spark, kept_snapshots
        self.root = root.rstrip("/")
        # Commit state per table as of this object's last look; its own commits refresh it.
        self._states: dict[str, Row | None] = {}

    # -- state ---------------------------------------------------------------

    def _state(self, name: str) -> Row | None:
        """Current snapshot number and schema, and high-water marks; ``None`` before any commit."""
        if name not in self._states:
            self._states[name] = self._load_state(name)
        return self._states[name]

    def _load_state(self, name: str) -> Row | None:
        path = f"{self.root}/{name}/_commits"
        if not path_exists(self.spark, path):
            return None
        # Marks come back as numbers, so the zone of the driver's clock does not matter.
        marks = F.max_by("marks", F.when(F.col("marks").isNotNull(), F.col("committed_at")))
        return self.spark.read.schema(LOG_SCHEMA).parquet(path).agg(
            F.max("snapshot").alias("snapshot"),
            F.transform_values(marks, lambda _, at: F.unix_micros(at)).alias("marks"),
            F.max_by("schema", "committed_at").alias("schema"),
        ).first()

    def _snapshot(self, name: str) -> int:
        state = self._state(name)
        return (state["snapshot"] or 0) if state else 0

    def _commit(
        self, name: str, snapshot: int, schema: T.StructType, batch: StreamBatch, marks: Marks, images_at: datetime | None = None
    ) -> None:
        query_id, batch_id = batch or (None, None)
        all_marks = {**self.marks(name), **marks} if marks else None
        row = [(snapshot, query_id, batch_id, all_marks, schema.json(), images_at or datetime.now(timezone.utc), images_at is not None)]
        (
            self.spark.createDataFrame(row, LOG_SCHEMA)
            .coalesce(1)
            .write.mode("append")
            .parquet(f"{self.root}/{name}/_commits")
        )
        self._states.pop(name, None)

    def exists(self, name: str) -> bool:
        return self._snapshot(name) > 0

    def last_batch(self, name: str, query_id: str) -> int | None:
        """Last batch of a stream (by the id its checkpoint gives it) in the table."""
        path = f"{self.root}/{name}/_commits"
        if not path_exists(self.spark, path):
            return None
        log = self.spark.read.schema(LOG_SCHEMA).parquet(path)
        return log.where(F.col("query_id") == query_id).agg(F.max("batch_id")).first()[0]

    def marks(self, name: str) -> dict[str, datetime]:
        """By input: the ingestion time up to which it is already in the table."""
        state = self._state(name)
        found = (state["marks"] if state else None) or {}
        return {k: _time(at) for k, at in found.items()}

    def last_commit(self, name: str) -> datetime | None:
        """Time of the newest commit, for :meth:`images_since`."""
        path = f"{self.root}/{name}/_commits"
        if not path_exists(self.spark, path):
            return None
        newest = self.spark.read.schema(LOG_SCHEMA).parquet(path).agg(F.max(F.unix_micros("committed_at"))).first()[0]
        return _time(newest)

    def read_at(self, name: str, commit: datetime) -> DataFrame | None:
        """The table as of one of its commits, while that snapshot is kept (a rebuilt table keeps the last few)."""
        log = self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.root}/{name}/_commits")
        row = log.filter(F.unix_micros("committed_at") == F.lit(micros(commit))).select("snapshot", "schema").first()
        path = f"{self.root}/{name}/snapshot={row['snapshot']}" if row else None
        if not path or not path_exists(self.spark, path):
            return None
        return self.spark.read.schema(T.StructType.fromJson(json.loads(row["schema"]))).parquet(path).drop(PARTITION)

    def images_since(self, name: str, seen: datetime) -> list[tuple[datetime, DataFrame]] | None:
        """Commits after ``seen`` with their images, oldest first; ``None`` if one of them kept none, as a rebuild.

        Images have ``before`` and ``after``: a row as it was and as it is, NULL where it was or is not there.
        """
        log = self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.root}/{name}/_commits")
        later = log.select(F.unix_micros("committed_at").alias("at"), "images").filter(F.col("at") > F.lit(micros(seen)))
        found = sorted(later.collect())
        paths = [(r["at"], f"{self.root}/{name}/_images/at={r['at']}") for r in found]
        if not all(r["images"] for r in found) or not all(path_exists(self.spark, p) for _, p in paths):
            return None
        return [(_time(at), self.spark.read.parquet(p)) for at, p in paths]

    # -- reading -------------------------------------------------------------

    def path(self, name: str) -> str:
        return f"{self.root}/{name}/snapshot={self._snapshot(name)}"

    def _stored(self, name: str) -> DataFrame:
        state = self._state(name)
        if not state or not state["snapshot"]:
            raise FileNotFoundError(f"table {name} has no committed snapshot under {self.root}")
        # With the recorded schema there is no footer to open, and a table without rows reads as empty.
        schema = T.StructType.fromJson(json.loads(state["schema"]))
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}/snapshot={state['snapshot']}")

    def read(self, name: str) -> DataFrame:
        return self._stored(name).drop(PARTITION)

    def read_or_none(self, name: str) -> DataFrame | None:
        return self.read(name) if self.exists(name) else None

    def read_range(self, name: str, date_col: str, start: date, end: date) -> DataFrame:
        """``start <= date_col < end`` of a month-partitioned table, opening only its months."""
        months = F.col(PARTITION).between(start.year * 100 + start.month, end.year * 100 + end.month)
        return between(self._stored(name).filter(months), date_col, start, end).drop(PARTITION)

    def read_from(self, name: str, date_col: str, start: date) -> DataFrame:
        """``date_col >= start`` of a month-partitioned table."""
        months = F.col(PARTITION) >= start.year * 100 + start.month
        return self._stored(name).filter(months & (F.col(date_col) >= F.lit(start))).drop(PARTITION)

    def read_partitions(self, name: str, values: Sequence[int]) -> DataFrame:
        return self._stored(name).filter(F.col(PARTITION).isin(*values)).drop(PARTITION)

    # -- writing -------------------------------------------------------------

    def overwrite(
        self,
        df: DataFrame,
        name: str,
        partition: Column | None = None,
        stream_batch: StreamBatch = None,
        marks: Marks = None,
    ) -> DataFrame:
        """Full rebuild (K6): write the next snapshot, then make it current."""
        snapshot = self._snapshot(name) + 1
        # A directory left by a run that died before its commit is replaced here.
        out = df if partition is None else _by_partition(df.withColumn(PARTITION, partition))
        writer = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if partition is not None:
            writer = writer.partitionBy(PARTITION)
        writer.parquet(f"{self.root}/{name}/snapshot={snapshot}")
        self._commit(name, snapshot, out.schema, stream_batch, marks)
        self._delete(f"{self.root}/{name}/snapshot={snapshot - self.kept_snapshots}")
        return self.read(name)

    def upsert(
        self,
        batch: DataFrame,
        name: str,
        keys: Sequence[str],
        partition: Column | None = None,
        order_by: Sequence[str] | None = None,
        full_refresh: bool = False,
        stream_batch: StreamBatch = None,
        marks: Marks = None,
        images: bool = False,
    ) -> DataFrame:
        """Replace rows by key (K5); the first run or a full refresh just writes (K7).

        Columns follow the batch: new ones appear, dropped ones go (K8).  With
        ``partition`` only the partitions involved are rewritten, and ``images``
        keeps what changed in them (for a batch with one row per key).
        """
        if full_refresh or not self.exists(name):
            return self.overwrite(batch, name, partition, stream_batch, marks)
        if partition is not None:
            return self._upsert_partitions(batch, name, keys, partition, order_by, stream_batch, marks, images)
        merged = upsert(align(self.read(name), batch.schema), batch, keys, order_by)
        return self.overwrite(merged, name, stream_batch=stream_batch, marks=marks)

    def _upsert_partitions(self, batch, name, keys, partition, order_by, stream_batch, marks, images) -> DataFrame:
        """Rewrite the partitions of the batch and those now holding one of its keys.

        The second kind matters when a row's date changed: it must leave its old
        partition.  The new content is written beside the table and swapped in
        from there, so a lost executor or a failed swap can be replayed from files.
        """
        snapshot, target = self._snapshot(name), self._stored(name)
        path = f"{self.root}/{name}/snapshot={snapshot}"
        work = f"{self.root}/{name}/_staged/{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}"
        # The batch is read several times below; store it once instead of recomputing its plan.
        batch = batch.withColumn(PARTITION, partition)
        batch.write.parquet(f"{work}/batch")
        batch = self.spark.read.schema(batch.schema).parquet(f"{work}/batch")
        held = target.select(*keys, PARTITION).join(batch.select(*keys), list(keys), "left_semi")
        touched = batch.select(PARTITION).union(held.select(PARTITION)).distinct()
        # One value per partition directory: the driver keeps such a list for any partitioned table.
        values = {r[0] for r in touched.collect()}
        at = datetime.now(timezone.utc) if images else None
        if images and not values:
            self._keep_images(batch, align(target.limit(0), batch.schema), name, keys, at)
        if values:
            current = align(target.filter(F.col(PARTITION).isin(*values)), batch.schema)
            if images:
                self._keep_images(batch, current, name, keys, at)
            merged = _by_partition(upsert(current, batch, keys, order_by))
            merged.write.partitionBy(PARTITION).parquet(f"{work}/merged")
            ready = self.spark.read.schema(batch.schema).parquet(f"{work}/merged")
            (
                ready.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(PARTITION)
                .parquet(path)
            )
            # A partition all of whose rows moved away is not in the merged data, so its directory goes.
            filled = {r[0] for r in ready.select(PARTITION).distinct().collect()}
            for value in values - filled:
                self._delete(f"{path}/{PARTITION}={value}")
        self._commit(name, snapshot, batch.schema, stream_batch, marks, at)
        self._delete(f"{self.root}/{name}/_staged")
        return self.read(name)

    def _keep_images(self, batch: DataFrame, current: DataFrame, name: str, keys: Sequence[str], at: datetime) -> None:
        """Rows of the batch that differ from what is stored, beside what is stored; before any partition is swapped."""
        columns = [c for c in batch.columns if c != PARTITION]
        key = F.struct(*keys).alias("__key")
        old = current.select(key, F.struct(*columns).alias("before"))
        new = batch.select(key, F.struct(*columns).alias("after"))
        changed = new.join(old, "__key", "left").filter(~F.col("before").eqNullSafe(F.col("after"))).select("before", "after")
        root = f"{self.root}/{name}/_images"
        changed.write.parquet(f"{root}/at={micros(at)}")
        log = self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.root}/{name}/_commits").filter("images")
        kept = [r[0] for r in log.select(F.unix_micros("committed_at")).collect()]
        for old_at in sorted(kept)[: -KEPT_IMAGES]:
            self._delete(f"{root}/at={old_at}")

    def drop_partitions(self, name: str, which: Callable[[int], bool]) -> list[int]:
        """Delete the partitions whose value ``which`` accepts; their files are not opened."""
        state = self._state(name)
        path = self.path(name)
        values = [f.getPath().getName() for f in self._list(path)]
        found = sorted(int(v.split("=")[1]) for v in values if v.startswith(f"{PARTITION}=") and v.split("=")[1].isdigit())
        gone = [v for v in found if which(v)]
        for value in gone:
            self._delete(f"{path}/{PARTITION}={value}")
        if gone:
            self._commit(name, self._snapshot(name), T.StructType.fromJson(json.loads(state["schema"])), None, None)
        return gone

    def _list(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        return hadoop_path.getFileSystem(conf).listStatus(hadoop_path)

    def _delete(self, path: str) -> None:
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        hadoop_path.getFileSystem(conf).delete(hadoop_path, True)

    # -- catalog -------------------------------------------------------------

    def register(self, name: str, table: str | None = None) -> str:
        """Expose the current snapshot as a catalog table, so it can carry statistics."""
        target = table or name
        self.spark.sql(f"DROP TABLE IF EXISTS {target}")
        self.spark.catalog.createTable(target, path=self.path(name), source="parquet")
        if any(c.isPartition for c in self.spark.catalog.listColumns(target)):
            self.spark.catalog.recoverPartitions(target)
        return target

    def analyze(self, table: str) -> None:
        """Statistics for the cost-based optimizer on a catalog table (K9)."""
        self.spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
