"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the data directory, ``BENCH_CPUS`` the local cores,
``BENCH_RUNS`` the runs per query, of which the fastest counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog import ALL  # noqa: E402
from emporio.session import build_session  # noqa: E402

HEADLINE = (
    "stg_dedup_latest", "keyed_upsert", "order_unified", "customer_unified_rfm", "product_catalog", "dim_customer_scd",
    "scd2_asof_lookup", "campaign_interval_join", "fact_sales", "fact_stock", "fact_delivery", "fact_ledger",
    "fact_session", "fact_budget", "measures_sales", "measure_period_shift", "measures_stock", "cohort_retention",
    "abc_curve", "pnl_month", "quality_rules", "reconcile",
)


def main() -> None:
    sf_dir = os.getenv("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.getenv("BENCH_CPUS", "8")
    runs = int(os.getenv("BENCH_RUNS", "2"))
    spark = build_session(
        "emporio-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.driver.host": "127.0.0.1",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        ALL[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timed("global_kpis")  # starts the executor threads and loads the readers
    queries = {name: round(min(timed(name) for _ in range(runs)), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "total_headline_seconds",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
