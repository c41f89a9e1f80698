"""Time the headline queries: one JSON line, seconds per query (median of the warm runs)."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shopgrain.catalog import REGISTRY  # noqa: E402
from shopgrain.session import clear_scratch, local_session  # noqa: E402

HEADLINE = [
    "silver_orders",
    "fact_orders",
    "gold_daily_sales",
    "gold_product_performance",
    "gold_customer_rfm",
    "gold_inventory_health",
    "silver_orders_expect",
    "merge_upsert",
    "scd_customers",
    "metric_query",
    "metric_revenue_mom_growth",
    "run_silver_tests",
    "stream_append_window_agg",
    "forecast_fit_predict",
    "zorder_layout",
]
WARM_RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def seconds(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cpus, "shopgrain-bench")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        seconds(spark, name, folder)
        runs = [seconds(spark, name, folder) for _ in range(WARM_RUNS)]
        times[name] = round(statistics.median(runs), 3)
    clear_scratch(spark)
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
        "runs": WARM_RUNS,
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
