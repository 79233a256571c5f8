"""Named queries over the star-schema snapshot: ``(spark, sf_dir) -> DataFrame``.

Each query builds the layer graph from the parquet tables and returns one
table of it, so every query reads whole tables and its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from retail_lakehouse import oracle_sql as O
from retail_lakehouse.plans import operator_queries
from retail_lakehouse.plans.layers import GOLD_NAMES, MART_NAMES, REPORT_NAMES, REPORT_TABLES, SILVER_NAMES, Lakehouse
from retail_lakehouse.plans.quality_suite import SUITE, data_quality_suite
from retail_lakehouse.plans.reports import check_reports
from retail_lakehouse.plans.silver import silver_order_items
from retail_lakehouse.operators.slice import orders_summary, replay_plan
from retail_lakehouse.schemas import DATASETS
from retail_lakehouse.sources import driver_tables as D

Query = Callable[[SparkSession, str], DataFrame]


def _bronze_q(table: str) -> Query:
    return lambda spark, sf: Lakehouse.from_driver(spark, sf).bronze(table)


def _silver_q(name: str) -> Query:
    return lambda spark, sf: Lakehouse.from_driver(spark, sf).silver(name)


def _gold_q(name: str, **kw) -> Query:
    return lambda spark, sf: Lakehouse.from_driver(spark, sf, **kw).gold(name)


def _mart_q(name: str, **kw) -> Query:
    return lambda spark, sf: Lakehouse.from_driver(spark, sf, **kw).mart(name)


def _report_q(name: str) -> Query:
    return lambda spark, sf: Lakehouse.from_driver(spark, sf).report(name)


def _check_reports(spark: SparkSession, sf: str) -> DataFrame:
    lh = Lakehouse.from_driver(spark, sf, materialize=REPORT_TABLES).build_layers()
    return check_reports({n: lh.report(n) for n in REPORT_NAMES})


def _raw_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    t = D.load_driver_tables(spark, sf)
    return {d.table_name: D.raw_table(t, d.table_name) for d in DATASETS}


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for d in DATASETS:
        q[f"bronze_{d.table_name}"] = _bronze_q(d.table_name)
    for n in SILVER_NAMES:
        q[f"silver_{n}"] = _silver_q(n)
    for n in GOLD_NAMES:
        q[n] = _gold_q(n)
    q["dim_date_iso"] = _gold_q("dim_date", week_start="iso")
    for n in MART_NAMES:
        q[n] = _mart_q(n)
    q["mart_delivery_performance_elapsed"] = _mart_q("mart_delivery_performance", day_basis="elapsed")
    for n in REPORT_NAMES:
        q[n] = _report_q(n)
    q["check_reports"] = _check_reports
    q["data_quality_suite"] = lambda spark, sf: data_quality_suite(Lakehouse.from_driver(spark, sf, materialize=("silver", "gold", "mart")))
    q["silver_order_items_md5"] = lambda spark, sf: silver_order_items(
        Lakehouse.from_driver(spark, sf).bronze("olist_order_items"), key_algo="md5")
    q["bronze_olist_orders_array_hash"] = lambda spark, sf: D.snapshot_bronze(
        D.load_driver_tables(spark, sf), "olist_orders", layout="array")
    q["replay_plan"] = lambda spark, sf: replay_plan(_raw_tables(spark, sf))
    q["source_summary"] = lambda spark, sf: orders_summary(_raw_tables(spark, sf)["olist_orders"])
    return q | operator_queries.QUERIES


def oracle_sql() -> dict[str, str]:
    s: dict[str, str] = {}
    for d in DATASETS:
        s[f"bronze_{d.table_name}"] = O.layer_query(f"bronze_{d.table_name}")
    for n in SILVER_NAMES:
        s[f"silver_{n}"] = O.layer_query(f"silver_{n}")
    for n in GOLD_NAMES:
        s[n] = O.layer_query(n)
    s["dim_date_iso"] = O.layer_query("dim_date_iso")
    for n in MART_NAMES:
        s[n] = O.layer_query(n)
    s["mart_delivery_performance_elapsed"] = O.layer_query("mart_delivery_performance_elapsed")
    for n in REPORT_NAMES:
        s[n] = O.layer_query(n)
    s["check_reports"] = O.check_reports_sql()
    s["data_quality_suite"] = O.quality_suite_sql(SUITE)
    s["silver_order_items_md5"] = O.with_ctes(O.SILVER["order_items"].replace(
        "sha256(concat_ws('||', order_id, order_item_id))", "md5(concat_ws('||', order_id, order_item_id))"))
    s["bronze_olist_orders_array_hash"] = O.bronze_array_sql("olist_orders")
    s["replay_plan"] = O.replay_plan_sql()
    s["source_summary"] = O.orders_summary_sql()
    return s | O.operator_queries_sql(SUITE)
