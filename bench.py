"""Seconds per headline query: median of three runs after a warm-up.

Every query is written to the noop sink, so all result rows and columns are
computed and none is kept.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parity.queries import QUERIES  # noqa: E402
from tillwork.session import build_session  # noqa: E402

HEADLINE = (
    "fact_store_day",
    "fact_store_day_by_self_join",
    "fact_store_day_with_month_close",
    "fact_sales",
    "fact_inventory",
    "fact_budget",
    "store_day_rollup",
    "running_month_and_year",
    "year_ago_range_frame",
    "year_ago_self_join",
    "till_lines_to_daily_sales",
    "till_lines_to_store_kpi",
    "inventory_ledger",
    "dedupe_by_key",
    "clean_pos_line",
    "null_safe_merge_state",
    "calendar_on_orders",
    "dashboard_company_day",
    "dashboard_category_day",
    "dashboard_comparable_week",
    "dashboard_store_traffic",
    "quality_suites",
    "layer_balances",
)


def seconds(spark, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": cpus,
            # A table of one file is one split; cut it for the cores of this machine.
            "spark.sql.files.minPartitionNum": cpus,
            "spark.sql.files.openCostInBytes": "1m",
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    measured = {}
    for name in names:
        seconds(spark, name, sf_dir)
        measured[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(3)), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(measured.values()), 3),
                "unit": "sec",
                "queries": measured,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
