"""The standing data-quality suite over every layer (DQ-7), as data.

Table names: ``bronze_<dataset>`` (landing text columns), ``silver_<name>``,
and the gold and mart table names.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame

from retail_lakehouse.operators.quality import Check, run_checks
from retail_lakehouse.plans.layers import GOLD_NAMES, MART_NAMES, Lakehouse
from retail_lakehouse.schemas import ORDER_STATUSES, REVIEW_SCORES
from retail_lakehouse.session import materialize, new_table_path, shuffles_dropped


def _nn_u(table: str, col: str) -> list[Check]:
    return [Check("not_null", table, col), Check("unique", table, col)]


def _rel(table: str, col: str, to: str, field: str) -> Check:
    return Check("relationships", table, col, to, field)


SUITE: tuple[Check, ...] = tuple(
    # landing sources
    _nn_u("bronze_olist_orders", "order_id")
    + [Check("not_null", "bronze_olist_orders", "customer_id"),
       Check("not_null", "bronze_olist_orders", "order_purchase_timestamp")]
    + [Check("not_null", "bronze_olist_order_items", c)
       for c in ("order_id", "order_item_id", "product_id", "seller_id")]
    # silver
    + _nn_u("silver_orders", "order_id")
    + [Check("not_null", "silver_orders", "customer_id"),
       _rel("silver_orders", "customer_id", "silver_customers", "customer_id"),
       Check("accepted_values", "silver_orders", "order_status", values=ORDER_STATUSES),
       Check("not_null", "silver_orders", "order_purchase_at")]
    + _nn_u("silver_order_items", "order_item_sk")
    + [_rel("silver_order_items", "order_id", "silver_orders", "order_id"),
       _rel("silver_order_items", "product_id", "silver_products", "product_id"),
       _rel("silver_order_items", "seller_id", "silver_sellers", "seller_id")]
    + _nn_u("silver_order_payments", "payment_sk")
    + [_rel("silver_order_payments", "order_id", "silver_orders", "order_id")]
    + _nn_u("silver_order_reviews", "review_id")
    + [_rel("silver_order_reviews", "order_id", "silver_orders", "order_id"),
       Check("accepted_values", "silver_order_reviews", "review_score", values=REVIEW_SCORES)]
    + _nn_u("silver_customers", "customer_id")
    + [Check("not_null", "silver_customers", "customer_unique_id")]
    + _nn_u("silver_products", "product_id")
    + _nn_u("silver_sellers", "seller_id")
    + _nn_u("silver_geolocation", "zip_code_prefix")
    # warehouse
    + _nn_u("dim_date", "date_key") + _nn_u("dim_date", "date_day")
    + _nn_u("dim_customers", "customer_id")
    + _nn_u("dim_products", "product_id")
    + _nn_u("dim_sellers", "seller_id")
    + _nn_u("dim_geography", "zip_code_prefix")
    + _nn_u("fct_orders", "order_id")
    + [_rel("fct_orders", "customer_id", "dim_customers", "customer_id"),
       _rel("fct_orders", "order_purchase_date", "dim_date", "date_day")]
    + _nn_u("fct_order_items", "order_item_sk")
    + [_rel("fct_order_items", "order_id", "fct_orders", "order_id"),
       _rel("fct_order_items", "product_id", "dim_products", "product_id"),
       _rel("fct_order_items", "seller_id", "dim_sellers", "seller_id")]
    # marts
    + _nn_u("mart_daily_sales", "order_purchase_date")
    + _nn_u("mart_delivery_performance", "order_purchase_date")
    + _nn_u("mart_seller_performance", "seller_id")
    + _nn_u("mart_customer_rfm", "customer_unique_id")
    # amounts never negative
    + [Check("non_negative", "fct_order_items", "item_price,freight_value"),
       Check("non_negative", "silver_order_payments", "payment_value")]
)


def table_resolver(lh: Lakehouse):
    def get(name: str) -> DataFrame:
        if name.startswith("bronze_"):
            return lh.bronze(name[len("bronze_"):])
        if name.startswith("silver_"):
            return lh.silver(name[len("silver_"):])
        if name in GOLD_NAMES:
            return lh.gold(name)
        if name in MART_NAMES:
            return lh.mart(name)
        raise KeyError(name)
    return get


# The tables whose keys are most of the suite's: each is checked for itself, and its relationships apart.
ALONE = ("silver_order_items", "silver_order_payments", "fct_order_items")


def part_of(check: Check) -> str:
    """The part of the suite that a check is run in, by its table."""
    if check.table in ALONE:
        return f"{check.table}.keys" if check.kind == "relationships" else check.table
    return next((p for p in ("bronze", "silver") if check.table.startswith(f"{p}_")), "gold")


def run_apart(tables: Callable[[str], DataFrame], suite: Sequence[Check] = SUITE) -> tuple[DataFrame, list[str]]:
    """``run_checks`` part by part, so that the shuffle of one part's keys goes before the next is made:
    the result, and the tables it is read from (a row per check)."""
    parts: dict[str, list[Check]] = {}
    for c in suite:
        parts.setdefault(part_of(c), []).append(c)
    stored, paths = [], []
    for name, checks in parts.items():
        df = run_checks(tables, checks)
        paths.append(new_table_path(df.sparkSession, f"checks-{name}"))
        with shuffles_dropped(df.sparkSession):
            stored.append(materialize(df, path=paths[-1]))
    return reduce(DataFrame.unionByName, stored), paths


def data_quality_suite(lh: Lakehouse, suite: Sequence[Check] = SUITE) -> DataFrame:
    """All checks of ``suite`` as one DataFrame. With a materializing
    Lakehouse, every layer is written once first (tiers built concurrently), checked and
    dropped when the layers above it have been built."""
    get, done = table_resolver(lh), []

    def checked(*parts: str) -> None:
        if of_parts := [c for c in suite if part_of(c).split(".")[0] in parts]:
            done.append(run_apart(get, of_parts)[0])

    lh.build_tier("silver")
    checked("bronze", "silver", "silver_order_items", "silver_order_payments")
    lh.build_tier("gold").drop("silver")
    checked("fct_order_items")
    lh.build_tier("mart")
    checked("gold")
    lh.drop("gold", "mart")
    return reduce(DataFrame.unionByName, done)
