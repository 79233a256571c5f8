"""Time the headline queries on the driver tables and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full through the ``noop`` sink (no rows to the
driver). ``value`` is the sum of the per-query median wall times; each query
runs ``BENCH_REPEAT`` times (default 3) after one warm-up of the session.
"""

from __future__ import annotations

import json
import os
import shutil
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from retail_lakehouse import registry  # noqa: E402
from retail_lakehouse.session import build_session, drop_materialized  # noqa: E402

HEADLINE = (
    "fct_orders",
    "fct_order_items",
    "mart_daily_sales",
    "mart_delivery_performance",
    "mart_seller_performance",
    "mart_customer_rfm",
    "report_executive_kpis",
    "report_top_sellers",
    "report_rfm_segments",
    "report_sales_by_state",
    "replay_plan",
    "data_quality_suite",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    folder = tempfile.mkdtemp(prefix="rl-bench-")
    spark = build_session(f"local[{cpus}]", cpus, app_name="retail_lakehouse_bench", checkpoint_dir=folder)
    q = registry.queries()
    names = only or list(HEADLINE)
    # warm-up: JVM, parquet footers, code generation caches
    q["report_executive_kpis"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            q[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
            drop_materialized(spark)
        timings[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()
    shutil.rmtree(folder, ignore_errors=True)


if __name__ == "__main__":
    main()
