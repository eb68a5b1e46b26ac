"""``python -m emporio.jobs.transform [--full-refresh] [--export DIR]``"""

from __future__ import annotations

import argparse
import os
import sys
from datetime import date, datetime, timezone

from emporio.config import WarehouseConfig
from emporio.plans.warehouse import Transform
from emporio.quality.rules import check_models
from emporio.registry import OPTIONAL_TABLES, TABLES
from emporio.session import build_session
from emporio.sinks.export import append_audit, export
from emporio.sources.bronze import missing_tables


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Refresh staging, intermediates, dimensions and facts")
    parser.add_argument("--bronze", default=os.getenv("EMPORIO_BRONZE", "data/bronze"))
    parser.add_argument("--warehouse", default=os.getenv("EMPORIO_WAREHOUSE", "data/warehouse"))
    parser.add_argument("--full-refresh", action="store_true")
    parser.add_argument("--keep-versions", action="store_true")
    parser.add_argument("--as-of", type=date.fromisoformat)
    parser.add_argument("--holidays", help="CSV seed; rules are used without it")
    parser.add_argument("--export", help="also write Gold as compressed Parquet here")
    parser.add_argument("--skip-tests", action="store_true")
    args = parser.parse_args(argv)
    spark = build_session("emporio-transform")
    cfg = WarehouseConfig(
        bronze_root=args.bronze, warehouse_root=args.warehouse, as_of=args.as_of, full_refresh=args.full_refresh,
        keep_versions=args.keep_versions, holiday_seed=args.holidays,
    )
    absent = [t for t in missing_tables(spark, TABLES, args.bronze) if t not in OPTIONAL_TABLES]
    if absent:
        print(f"no data for {absent}", file=sys.stderr)
        return 1
    frames = Transform(spark, cfg).run()
    failed = [] if args.skip_tests else check_models(frames).filter("not passed").collect()
    for row in failed:
        print(f"{row['table']} {row['rule']}: {row['violations']} violations", file=sys.stderr)
    if failed:
        return 1
    if args.export:
        gold = {n: df for n, df in frames.items() if n.startswith(("dim_", "fato_"))}
        export(gold, args.export)
        audit = spark.createDataFrame(
            [(datetime.now(timezone.utc), args.export, len(gold))], "at timestamp, path string, tables int"
        )
        append_audit(audit, f"{args.warehouse.rstrip('/')}/_audit/export")
    return 0


if __name__ == "__main__":
    sys.exit(main())
