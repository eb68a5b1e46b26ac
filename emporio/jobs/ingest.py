"""``python -m emporio.jobs.ingest --mode smart [--table vendas.pedidos]``

Connection settings come from ``EMPORIO_JDBC_URL``, ``EMPORIO_JDBC_DRIVER``,
``EMPORIO_JDBC_USER`` and ``EMPORIO_JDBC_PASSWORD``.
"""

from __future__ import annotations

import argparse
import os
import sys
import uuid
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporio.registry import TableEntry, find
from emporio.session import build_session
from emporio.sinks.bronze import append_bronze
from emporio.sinks.control import WatermarkLog, resolve_mode
from emporio.sinks.export import TaskResult, run_all
from emporio.sources.bronze import delete_path
from emporio.sources.jdbc import EPOCH, JdbcConf, extract_incremental

Extract = Callable[[TableEntry, datetime], DataFrame]


def process_table(
    spark: SparkSession, entry: TableEntry, mode: str, bronze_root: str, ingested_at: datetime, extract: Extract
) -> dict:
    """Extract, land, then move the watermark; a failure before that leaves the mark unmoved."""
    log = WatermarkLog(spark, bronze_root)
    mode = resolve_mode(spark, entry, mode, bronze_root)
    watermark = EPOCH if mode == "full" else log.read(entry)
    # The source is read once: what it gave is kept, and counted and landed from there.
    kept = f"{bronze_root.rstrip('/')}/_extracted/{entry.watermark_key}-{uuid.uuid4().hex}"
    schema = entry.source_schema
    extract(entry, watermark).select(*schema.names).write.parquet(kept)
    try:
        batch = spark.read.schema(schema).parquet(kept)
        size = batch.agg(F.count(F.lit(1)).alias("n"), F.unix_micros(F.max(entry.watermark_col)).alias("top")).first()
        if not size["n"]:
            log.touch(entry, ingested_at)
            return {"table": entry.full_name, "rows": 0, "status": "skip"}
        append_bronze(batch, entry, bronze_root, ingested_at, size["n"])
    finally:
        delete_path(spark, kept)
    if size["top"] is None:  # nothing but rows without a mark
        log.touch(entry, ingested_at)
        return {"table": entry.full_name, "rows": size["n"], "watermark": None, "status": "ok"}
    top = datetime.fromtimestamp(size["top"] // 1_000_000, tz=timezone.utc) + timedelta(microseconds=size["top"] % 1_000_000)
    log.commit(entry, top, ingested_at)
    return {"table": entry.full_name, "rows": size["n"], "watermark": top.isoformat(), "status": "ok"}


def ingest(
    spark: SparkSession,
    bronze_root: str,
    extract: Extract,
    mode: str = "smart",
    tables: list[str] | None = None,
    ingested_at: datetime | None = None,
    parallel: int = 4,
) -> list[TaskResult]:
    """Process the tables independently; failures are reported, not raised."""
    at = ingested_at or datetime.now(timezone.utc)
    return run_all(
        {
            e.full_name: (lambda e=e: process_table(spark, e, mode, bronze_root, at, extract))
            for e in find(tables)
        },
        parallel,
    )


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Land changed source rows in Bronze")
    parser.add_argument("--mode", choices=["full", "incremental", "smart"], required=True)
    parser.add_argument("--table", action="append", help="only this table, e.g. vendas.pedidos")
    parser.add_argument("--bronze", default=os.getenv("EMPORIO_BRONZE", "data/bronze"))
    args = parser.parse_args(argv)
    try:
        find(args.table)
    except KeyError as exc:
        print(exc.args[0], file=sys.stderr)
        return 1
    spark = build_session("emporio-ingest")
    jdbc = JdbcConf(
        os.environ["EMPORIO_JDBC_URL"],
        os.getenv("EMPORIO_JDBC_DRIVER"),
        os.getenv("EMPORIO_JDBC_USER"),
        os.getenv("EMPORIO_JDBC_PASSWORD"),
    )
    results = ingest(
        spark, args.bronze, lambda entry, mark: extract_incremental(spark, entry, jdbc, mark), args.mode, args.table
    )
    rows = sum(r.value["rows"] for r in results if r.ok)
    print(f"{sum(r.ok for r in results)}/{len(results)} tables, {rows} rows")
    for failed in (r for r in results if not r.ok):
        print(f"{failed.name}: {failed.error}", file=sys.stderr)
    return 0 if all(r.ok for r in results) else 1


if __name__ == "__main__":
    sys.exit(main())
