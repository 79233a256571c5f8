"""Plan-shape guards for the scale properties the operators rely on: partial
aggregation before every hot-key shuffle, the partial row-number limit, the
spread-out distinct count, and column pruning into the parquet scan. Checked
on the initial physical plan (no data needs to be read)."""

import os
import re

import pytest

from retail_lakehouse import registry
from retail_lakehouse.operators.quality import orphan_keys
from retail_lakehouse.sources import driver_tables as D

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def plan(df) -> list[str]:
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def directly_below(lines: list[str], upper: str, lower: str) -> bool:
    """Some ``upper`` node whose child (next line) is a ``lower`` node."""
    return any(re.search(upper, a) and re.search(lower, b) for a, b in zip(lines, lines[1:]))


def test_bronze_dedup_combines_copies_before_the_shuffle(spark):
    lines = plan(D.snapshot_bronze(D.load_driver_tables(spark, SF), "olist_order_items"))
    # partial (map-side) aggregate under the exchange: a group of copies
    # crosses the shuffle as one row per map task
    # on typed columns, before they are made text
    assert directly_below(lines, r"Exchange hashpartitioning\(.*l_orderkey", r"HashAggregate\(keys=\[.*l_orderkey")


def test_relationship_check_counts_child_keys_before_the_shuffle(spark):
    t = D.load_driver_tables(spark, SF)
    child = t["lineitem"].select("l_orderkey")
    parent = t["orders"].select("o_orderkey")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the parent as if too big to broadcast
    try:
        lines = plan(orphan_keys(child, "l_orderkey", parent, "o_orderkey"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert directly_below(lines, r"Exchange hashpartitioning\(l_orderkey", r"partial_count")
    # one shuffle per side; the join reuses the aggregates' partitioning
    assert sum("Exchange" in l for l in lines) == 2
    assert any("SortMergeJoin" in l for l in lines)


def test_latest_version_limits_each_key_before_the_shuffle(spark):
    lines = plan(registry.queries()["silver_order_reviews"](spark, SF))
    limits = [i for i, l in enumerate(lines) if "WindowGroupLimit" in l]
    exchanges = [i for i, l in enumerate(lines) if "Exchange hashpartitioning(review_id" in l]
    assert exchanges and len(limits) >= 2
    # one limit above the review shuffle (final), one below it (partial)
    assert any(i < exchanges[0] for i in limits) and any(i > exchanges[0] for i in limits)


def test_distinct_counts_per_order_spread_a_hot_order(spark):
    lines = plan(registry.queries()["fct_orders"](spark, SF))
    assert any("Expand" in l for l in lines)
    # the first shuffle of the distinct counts is keyed by (order, product/seller),
    # not by the order alone
    keyed = r"Exchange hashpartitioning\(order_id#\d+, (product|seller)_id#\d+, (product|seller)_id#\d+, gid"
    assert any(re.search(keyed, l) for l in lines)


def test_scans_read_only_the_columns_they_use(spark):
    lines = plan(registry.queries()["mart_daily_sales"](spark, SF))
    schemas = [l for l in lines if "ReadSchema" in l and "lineitem.parquet" in l]
    assert schemas
    for s in schemas:
        for unused in ("l_quantity", "l_discount", "l_linestatus"):
            assert unused not in s


def test_sales_by_state_rolls_orders_up_per_customer_before_the_join(spark):
    lines = plan(registry.queries()["report_sales_by_state"](spark, SF))
    assert directly_below(lines, r"Exchange hashpartitioning\(customer_id#\d+, \d+\)",
                          r"HashAggregate\(keys=\[customer_id#\d+\], functions=\[partial_count")


def test_seller_order_pairs_are_combined_before_the_join(spark):
    lines = plan(registry.queries()["mart_seller_performance"](spark, SF))
    assert directly_below(lines, r"Exchange hashpartitioning\(seller_id#\d+, order_id#\d+, \d+\)",
                          r"HashAggregate\(keys=\[seller_id#\d+, order_id#\d+\], functions=\[partial_count")


@pytest.mark.parametrize("query,most", [("fct_orders", 9), ("mart_seller_performance", 13), ("silver_order_reviews", 1)])
def test_exchanges_do_not_creep_in(spark, query, most):
    lines = plan(registry.queries()[query](spark, SF))
    assert sum("Exchange hashpartitioning" in l for l in lines) <= most
