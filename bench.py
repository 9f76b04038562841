"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) is the data folder, BENCH_CPUS the
number of local cores. All queries run once to warm up, then BENCH_RUNS times
each; the median counts. Results go to the ``noop`` sink, so every row and column is
computed. BENCH_QUERIES may name other registered queries, separated by commas.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from pathlib import Path

from shelfline.registry import QUERIES
from shelfline.sources.session import build_session

HEADLINE = (
    "revenue_mart",
    "channel_performance_mart",
    "customer_360_mart",
    "inventory_turnover_mart",
    "silver_orders",
    "silver_customers",
    "silver_products",
    "silver_inventory",
    "contract_report_clean",
    "contract_report_dirty",
    "dq_bronze_storefront",
    "dq_silver_orders",
    "channel_mom",
    "silver_as_of",
    "late_arrival_profile",
    "run_status_24h",
    "run_duration_7d",
    "lineage_edges",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        extra={
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )

    def timed(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    for name in names:
        timed(name)
    seconds = {name: round(statistics.median(timed(name) for _ in range(runs)), 3) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": cpus,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
