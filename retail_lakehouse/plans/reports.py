"""The six standing reports (RP-1 … RP-6) and the report check (RP-7)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lakehouse.functions.columns import exact_avg, exact_quotient, rfm_segment


def report_executive_kpis(fct_orders: DataFrame) -> DataFrame:
    """One row. ``total_customers`` counts order-level customer ids."""
    return fct_orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_distinct("customer_id").alias("total_customers"),
        F.sum("item_count").alias("total_items"),
        F.sum("payment_total").cast("decimal(16,2)").alias("gross_payment_value"),
        exact_avg("payment_total", 2, input_scale=2, precision=14).alias("average_order_value"),
        exact_avg("average_review_score", 2, input_scale=2, precision=4).alias("average_review_score"),
    )


def report_daily_sales(mart_daily_sales: DataFrame) -> DataFrame:
    return mart_daily_sales.select(
        "order_purchase_date", "order_count", "item_count", "item_subtotal", "freight_total",
        "order_line_total", "payment_total", "average_review_score",
    ).orderBy("order_purchase_date")


def report_delivery_performance(mart_delivery_performance: DataFrame) -> DataFrame:
    return mart_delivery_performance.select(
        "order_purchase_date",
        "order_count",
        "delivered_order_count",
        "late_delivery_count",
        (F.lit(100) * F.col("late_delivery_rate")).cast("decimal(8,2)").alias("late_delivery_percentage"),
        "average_delivery_days",
        "average_days_vs_estimate",
    ).orderBy("order_purchase_date")


def report_top_sellers(mart_seller_performance: DataFrame, k: int = 10) -> DataFrame:
    """First ``k`` sellers by line total (seller id breaks ties). Planned as
    ``TakeOrderedAndProject``: each task keeps its own top k."""
    return (
        mart_seller_performance.orderBy(F.col("order_line_total").desc_nulls_last(), F.col("seller_id").asc())
        .limit(k)
        .select(
            "seller_id", "seller_city", "seller_state", "order_count", "item_count", "item_subtotal",
            "freight_total", "order_line_total", "average_item_price", "average_review_score",
        )
    )


def report_rfm_segments(mart_customer_rfm: DataFrame) -> DataFrame:
    seg = mart_customer_rfm.select(
        "customer_unique_id",
        "monetary_value",
        "average_order_value",
        rfm_segment("recency_score", "frequency_score", "monetary_score").alias("customer_segment"),
    )
    return seg.groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum("monetary_value").cast("decimal(16,2)").alias("segment_value"),
        exact_avg("average_order_value", 2, input_scale=2, precision=14).alias("average_order_value"),
    ).orderBy(F.col("segment_value").desc_nulls_last(), F.col("customer_segment"))


def report_sales_by_state(fct_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Orders, customers and payments per customer state.

    Orders are first rolled up per ``customer_id`` (partial aggregate in every
    map task), so only one row per customer meets the dimension and a customer
    holding a third of all orders never lands in one join task. The average
    is rebuilt exactly from the rolled-up sums and counts.
    """
    per_customer = fct_orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_orders"),
        F.sum("payment_total").alias("_paid"),
        F.count("payment_total").alias("_paid_n"),
    )
    c = dim_customers.select(F.col("customer_id").alias("_c_id"), "customer_state")
    joined = per_customer.join(c, per_customer["customer_id"] == c["_c_id"], "inner")
    return joined.groupBy("customer_state").agg(
        F.sum("_orders").alias("order_count"),
        F.count_distinct("customer_id").alias("customer_count"),
        F.sum("_paid").cast("decimal(16,2)").alias("gross_payment_value"),
        exact_quotient(F.sum("_paid"), F.sum("_paid_n"), 2, num_scale=2, precision=14).alias("average_order_value"),
    ).orderBy(F.col("gross_payment_value").desc_nulls_last(), F.col("customer_state"))


def check_reports(reports: Mapping[str, DataFrame]) -> DataFrame:
    """Every report with the number of rows it returns (a failing report raises
    when the result is computed). One small aggregate per report, unioned into
    one job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("report_name"), "row_count")
        for name, df in reports.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
