"""Time the headline queries on local Spark and print one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (threads), BENCH_QUERIES (comma list).
Each query is written to the no-op sink, so every row and column is computed. All queries run
once before any is timed, to leave JVM warm-up out; then each counts as the median of three
runs. Nothing is cached between the runs.
"""

from __future__ import annotations

import json
import os
import time
from statistics import median

from stockflow.queries import QUERIES
from stockflow.session import build_session

HEADLINE = [
    "order_readiness",
    "order_readiness_clamped",
    "order_readiness_by_block",
    "policy_diff",
    "current_inventory",
    "projected_inventory",
    "readiness_summary",
    "attention_orders",
    "shortage_by_warehouse",
    "top_product_volume",
    "top_adjustments",
    "delay_rate",
    "quality_report",
    "inventory_trend",
    "plan_vs_posted",
    "publish_readiness",
    "gen_transactions",
    "gen_ledger",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in names:
        run(name)
    seconds = {name: round(median(run(name) for _ in range(3)), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
