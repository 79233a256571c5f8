"""Marts (MT-1 … MT-4): daily sales, delivery performance, seller performance,
customer recency/frequency/monetary scores.

Every average that ends in a fixed-scale decimal is computed exactly
(``exact_avg``), never through a double or a 6-digit decimal intermediate.
No status filter anywhere: canceled orders count in every mart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lakehouse.functions.columns import (
    MICROS_PER_DAY,
    elapsed_micros,
    exact_avg,
    exact_quotient,
)
from retail_lakehouse.operators.selection import bucket_by_starts, order_key, quantile_starts
from retail_lakehouse.session import materialize


def _sum16(c: str):
    return F.sum(c).cast("decimal(16,2)").alias(c)


def mart_daily_sales(fct_orders: DataFrame) -> DataFrame:
    return fct_orders.groupBy("order_purchase_date").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("item_count").alias("item_count"),
        _sum16("item_subtotal"),
        _sum16("freight_total"),
        _sum16("order_line_total"),
        _sum16("payment_total"),
        # mean of the per-order averages (already at 2 dp)
        exact_avg("average_review_score", 2, input_scale=2, precision=4).alias("average_review_score"),
    )


def mart_delivery_performance(fct_orders: DataFrame, day_basis: str = "calendar") -> DataFrame:
    """Per purchase date: orders, delivered, late (delivered after the
    estimate; no delivery is not late), late rate over delivered orders (NULL
    when none) and average days.

    ``day_basis="calendar"`` counts whole calendar days (``datediff``);
    ``"elapsed"`` uses the exact elapsed time in days.
    """
    delivered = F.col("order_delivered_customer_at")
    is_delivered = delivered.isNotNull()
    is_late = delivered > F.col("order_estimated_delivery_at")
    if day_basis == "calendar":
        delivery_days = exact_avg(F.datediff(delivered, F.col("order_purchase_at")), 2, precision=10)
        vs_estimate = exact_avg(F.datediff(delivered, F.col("order_estimated_delivery_at")), 2, precision=10)
    elif day_basis == "elapsed":
        # Years of microseconds over a day's orders, in hundredths, pass the range of a long.
        def mean_days(start: str):
            micros = elapsed_micros(delivered, F.col(start)).cast("decimal(19,0)")
            return exact_quotient(F.sum(micros), F.count(micros).cast("decimal(20,0)") * F.lit(MICROS_PER_DAY).cast("decimal(11,0)"), 2, precision=10)

        delivery_days, vs_estimate = mean_days("order_purchase_at"), mean_days("order_estimated_delivery_at")
    else:
        raise ValueError(f"unknown day_basis {day_basis!r}")
    return fct_orders.groupBy("order_purchase_date").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.count_if(is_delivered).alias("delivered_order_count"),
        F.count_if(F.coalesce(is_late, F.lit(False))).alias("late_delivery_count"),
        exact_quotient(F.count_if(F.coalesce(is_late, F.lit(False))), F.count_if(is_delivered), 4,
                       precision=8).alias("late_delivery_rate"),
        delivery_days.alias("average_delivery_days"),
        vs_estimate.alias("average_days_vs_estimate"),
    )


def mart_seller_performance(dim_sellers: DataFrame, fct_order_items: DataFrame,
                            fct_orders: DataFrame) -> DataFrame:
    """Sellers with sales, in one pass over the order lines.

    Lines are rolled up per (seller, order) first (partial in every map task),
    so an order with many lines of one seller meets the orders once and counts
    once in the review average. Orders are reduced to one row per order id: its
    distinct (date, score) rows as a count, dates and sums. So copies of an
    order row neither multiply item sums nor count twice, and versions of one
    order that differ in date or score all count.
    """
    lines = fct_order_items.groupBy("seller_id", "order_id").agg(
        F.count(F.lit(1)).alias("_items"),
        F.sum("item_price").alias("_price"),
        F.count("item_price").alias("_prices"),
        F.sum("freight_value").alias("_freight"),
        F.sum("order_line_total").alias("_total"),
    )
    versions = fct_orders.select("order_id", "order_purchase_date", "average_review_score").distinct()
    orders = versions.groupBy(F.col("order_id").alias("_o_order_id")).agg(
        F.count(F.lit(1)).alias("_orders"),
        F.min("order_purchase_date").alias("_first"),
        F.max("order_purchase_date").alias("_last"),
        F.sum("average_review_score").alias("_score"),
        F.count("average_review_score").alias("_scores"),
    )
    # Left: a line counts for its seller's item sums whether or not its order is known.
    joined = lines.join(orders, F.col("order_id") == F.col("_o_order_id"), "left")
    sellers = joined.groupBy("seller_id").agg(
        F.sum("_orders").alias("order_count"),
        F.sum("_items").alias("item_count"),
        F.sum("_price").cast("decimal(16,2)").alias("item_subtotal"),
        F.sum("_freight").cast("decimal(16,2)").alias("freight_total"),
        F.sum("_total").cast("decimal(16,2)").alias("order_line_total"),
        exact_quotient(F.sum("_price"), F.sum("_prices"), 2, num_scale=2, precision=14).alias("average_item_price"),
        exact_quotient(F.sum("_score"), F.sum("_scores"), 2, num_scale=2, precision=4).alias("average_review_score"),
        F.min("_first").alias("first_order_date"),
        F.max("_last").alias("last_order_date"),
    ).where(F.col("order_count") > 0)
    return dim_sellers.join(sellers, "seller_id", "inner").select(
        "seller_id",
        "seller_city",
        "seller_state",
        "zip_code_prefix",
        "order_count",
        "item_count",
        "item_subtotal",
        "freight_total",
        "order_line_total",
        "average_item_price",
        "average_review_score",
        "first_order_date",
        "last_order_date",
    )


def rfm_metrics(fct_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Per person: last order, distinct orders, total and average payment.

    Orders are rolled up per (customer, order) before they meet the customers,
    so a customer key that holds a third of the orders crosses the shuffle as
    one row per order and map task at most; payments are carried as sum and count
    and the average is rebuilt from them exactly."""
    per_order = fct_orders.groupBy("customer_id", "order_id").agg(
        F.max("order_purchase_date").alias("_last"),
        F.sum("payment_total").alias("_paid"),
        F.count("payment_total").alias("_paid_n"),
    )
    c = dim_customers.select(F.col("customer_id").alias("_c_id"), "customer_unique_id")
    customer_orders = per_order.join(c, per_order["customer_id"] == c["_c_id"], "inner")
    return customer_orders.groupBy("customer_unique_id").agg(
        F.max("_last").alias("last_order_date"),
        F.count_distinct("order_id").alias("order_count"),
        F.sum("_paid").cast("decimal(16,2)").alias("monetary_value"),
        exact_quotient(F.sum("_paid"), F.sum("_paid_n"), 2, num_scale=2, precision=14).alias("average_order_value"),
    )


def mart_customer_rfm(fct_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """RFM scores by quintile: recency 5 = most recent, frequency and monetary
    5 = highest. Ties are broken by ``customer_unique_id`` so the scores are
    repeatable. Recency counts from the day after the last order of all.

    The metrics (one row per person) are written once to the shared checkpoint
    folder. The first rows of the quintiles of all three orders are selected
    together (``quantile_starts``); a score is then a comparison with these rows,
    so no person row is sorted, ranked, joined or written again.
    """
    m = materialize(rfm_metrics(fct_orders, dim_customers), "rfm-metrics")
    snapshot = m.select(F.date_add(F.max("last_order_date"), 1)).scalar()
    recency = F.datediff(snapshot, F.col("last_order_date"))
    # The fewest days since the last order: the latest date first.
    keys = {
        "recency": order_key(m, "last_order_date", descending=True),
        "frequency": order_key(m, "order_count"),
        "monetary": order_key(m, "monetary_value"),
    }
    starts = quantile_starts(m, 5, keys, "customer_unique_id")
    quintile = {name: bucket_by_starts(starts[name], key, "customer_unique_id") for name, key in keys.items()}
    return m.select(
        "customer_unique_id",
        snapshot.alias("snapshot_date"),
        "last_order_date",
        recency.alias("recency_days"),
        "order_count",
        "monetary_value",
        "average_order_value",
        (F.lit(6) - quintile["recency"]).cast("int").alias("recency_score"),
        quintile["frequency"].alias("frequency_score"),
        quintile["monetary"].alias("monetary_score"),
    ).withColumn("rfm_score", F.concat(F.col("recency_score").cast("string"), F.col("frequency_score").cast("string"),
                                       F.col("monetary_score").cast("string")))
