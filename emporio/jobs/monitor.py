"""``python -m emporio.jobs.monitor freshness|reconcile ...``

Exit code 1 when an error-level check fails; warnings never fail a run.
"""

from __future__ import annotations

import argparse
import os
import sys
from datetime import datetime, timezone

from emporio.plans.warehouse import INCREMENTAL
from emporio.quality.freshness import TOLERANCE_HOURS, check_freshness
from emporio.quality.reconcile import database_scalars, judge, scalars, select_checks
from emporio.session import build_session
from emporio.sinks.export import append_audit
from emporio.sinks.tables import Warehouse
from emporio.sources.jdbc import JdbcConf

FACTS = tuple(n for n in INCREMENTAL if n.startswith("fato_")) + ("fato_orcamento",)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Check freshness, or Gold against the source")
    parser.add_argument("what", choices=["freshness", "reconcile"])
    parser.add_argument("--bronze", default=os.getenv("EMPORIO_BRONZE", "data/bronze"))
    parser.add_argument("--warehouse", default=os.getenv("EMPORIO_WAREHOUSE", "data/warehouse"))
    parser.add_argument("--tolerance-hours", type=int, default=TOLERANCE_HOURS)
    parser.add_argument("--skip-batch-size", action="store_true")
    parser.add_argument("--table", help="prefix of the reconciliation checks to run")
    parser.add_argument("--tolerance", type=float)
    parser.add_argument("--output", help="directory of the JSON report")
    args = parser.parse_args(argv)
    spark = build_session("emporio-monitor")
    now = datetime.now(timezone.utc)
    warehouse = Warehouse(spark, args.warehouse)
    gold = {n: warehouse.read(n) for n in FACTS if warehouse.exists(n)}
    if args.what == "freshness":
        result = check_freshness(spark, args.bronze, gold, now, args.tolerance_hours, not args.skip_batch_size)
    else:
        jdbc = JdbcConf(os.environ["EMPORIO_JDBC_URL"], os.getenv("EMPORIO_JDBC_DRIVER"),
                        os.getenv("EMPORIO_JDBC_USER"), os.getenv("EMPORIO_JDBC_PASSWORD"))
        options = {k: v for k, v in vars(jdbc).items() if v is not None}
        checks = select_checks(args.table, args.tolerance)
        # Gold is summed here, the source where it is: one row per table is fetched.
        found = scalars(gold, checks, "gold", now.date()), database_scalars(spark, options, checks, now.date())
        result = judge(*found, checks)
    rows = result.collect()
    append_audit(spark.createDataFrame(rows, result.schema), args.output or f"{args.warehouse.rstrip('/')}/_audit/{args.what}")
    failed = [r for r in rows if not r["passed"]]
    for row in failed:
        print(row.asDict(), file=sys.stderr)
    errors = [r for r in failed if "severity" not in r.asDict() or r["severity"] == "error"]
    return 1 if errors else 0


if __name__ == "__main__":
    sys.exit(main())
