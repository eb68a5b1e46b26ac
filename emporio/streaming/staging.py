"""Bronze to staging as a file stream that stops when it has caught up."""

from __future__ import annotations

from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from emporio.plans.staging import build_staging, id_partition
from emporio.registry import TableEntry
from emporio.sinks.tables import Warehouse
from emporio.sources.bronze import table_path


def stream_staging(
    spark: SparkSession, entry: TableEntry, bronze_root: str, warehouse: Warehouse, checkpoint: str,
    files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Apply every Bronze file not seen yet to the staging table.

    The checkpoint remembers the files, in place of the ``_ingested_at`` filter
    of the batch form.  A batch replayed after a failure is recognised by the id
    that the checkpoint gives the query and the batch's number, and applied once;
    a new checkpoint is a new query, and its batches are applied from the first
    on.  Even applied twice a batch would replace rows by themselves.
    """
    reader = spark.readStream.schema(entry.bronze_schema).option("recursiveFileLookup", "true")
    reader = reader.option("pathGlobFilter", "*.parquet")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    source = reader.parquet(table_path(entry, bronze_root))

    known, query_id = Event(), []

    def apply(batch: DataFrame, batch_id: int) -> None:
        known.wait()  # the first batch may begin before start() has returned
        done = warehouse.last_batch(entry.staging_name, query_id[0])
        if done is not None and done >= batch_id:
            return
        warehouse.upsert(
            build_staging(batch, entry),
            entry.staging_name,
            entry.natural_key,
            partition=id_partition(entry),
            order_by=("updated_at", "_ingested_at"),
            stream_batch=(query_id[0], batch_id),
        )

    query = (
        source.writeStream.foreachBatch(apply)
        .trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .start()
    )
    query_id.append(str(query.id))
    known.set()
    return query
