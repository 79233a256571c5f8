"""Summarise the physical plans of the main queries (after execution, so the
AQE-final plan is shown): exchanges, broadcasts, joins, aggregates, windows,
scans with their pruned read schemas and pushed filters.

    python tools/plan_summary.py /root/testdata/sf0.01 > PLANS.md
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from retail_lakehouse import registry  # noqa: E402
from retail_lakehouse.session import build_session  # noqa: E402

NAMES = ("fct_orders", "mart_seller_performance", "mart_customer_rfm", "report_sales_by_state",
         "report_top_sellers", "replay_plan", "silver_order_reviews", "silver_geolocation")
KINDS = ("Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
         "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Expand", "Window", "WindowGroupLimit",
         "TakeOrderedAndProject", "Sort", "AQEShuffleRead", "ReusedExchange")


def final_plan_details(text: str) -> str:
    """The node details of the AQE final plan only (an executed adaptive plan
    is explained with its final and its initial tree)."""
    if "== Final Plan ==" in text:
        tree = text.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    else:
        tree = text.split("\n\n", 1)[0]
    ids = set(re.findall(r"\((\d+)\)", tree))
    blocks = re.split(r"\n(?=\(\d+\) )", text)
    return "\n".join(b for b in blocks if (m := re.match(r"\((\d+)\) ", b)) and m.group(1) in ids)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    q = registry.queries()
    print("# Physical plans (AQE final), sf =", os.path.basename(sf), "\n")
    for name in NAMES:
        df = q[name](spark, sf)
        # Run the DataFrame's own plan (a write would plan a new query), so the
        # explain below shows the AQE-final plan; rows stay on the executors.
        df._jdf.queryExecution().toRdd().count()
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain("formatted")
        text = final_plan_details(buf.getvalue())
        ops = re.findall(r"^\(\d+\) (\w+)", text, re.M)
        counts = {k: ops.count(k) for k in KINDS if ops.count(k)}
        print(f"## {name}\n")
        print("operators: " + ", ".join(f"{k} × {v}" for k, v in counts.items()) + "\n")
        keys = sorted(set(re.findall(r"Arguments: (hashpartitioning\([^)]*\)|rangepartitioning\([^)]*\)|"
                                     r"RoundRobinPartitioning\(\d+\)|SinglePartition)", text)))
        if keys:
            print("shuffle partitionings:\n")
            for k in keys:
                clean = re.sub(r"#\d+L?", "", k)
                print(f"- `{clean}`")
            print()
        scans = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", text)))
        if scans:
            print("scans (ReadSchema):\n")
            for s in scans:
                print(f"- `{s}`")
            print()
        pushed = sorted(set(re.findall(r"PushedFilters: (\[[^\]]*\])", text)) - {"[]"})
        if pushed:
            print("pushed filters: " + ", ".join(f"`{p}`" for p in pushed) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
