"""Gold star schema: five dimensions and two facts (DM-1 … DM-5, FC-1, FC-2)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lakehouse.functions.columns import default_chain, exact_avg, iso_day_of_week


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "customer_unique_id", "zip_code_prefix",
                            "customer_city", "customer_state")


def dim_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category name, falling back to the original
    name and then ``'unknown'``. The translation side has one row per
    category (silver dedups it), so the left join never fans out. No
    broadcast hint: AQE broadcasts it from its measured runtime size when it
    is small, and shuffles otherwise."""
    t = translation.select(
        F.col("product_category_name").alias("_category"),
        F.col("product_category_name_english").alias("_english"),
    )
    joined = products.join(t, products["product_category_name"] == t["_category"], "left")
    return joined.select(
        "product_id",
        "product_category_name",
        default_chain("_english", "product_category_name", default="unknown")
        .alias("product_category_name_english"),
        "product_name_length",
        "product_description_length",
        "product_photos_quantity",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select("seller_id", "zip_code_prefix", "seller_city", "seller_state")


def dim_geography(geolocation: DataFrame) -> DataFrame:
    return geolocation.select("zip_code_prefix", "latitude", "longitude", "city", "state")


def dim_date(orders: DataFrame, week_start: str = "sunday") -> DataFrame:
    """Calendar from the first purchase date to the later of the last purchase
    and the last estimated delivery.

    ``week_start="sunday"``: day numbers Sunday = 1 … Saturday = 7;
    ``"iso"``: Monday = 1 … Sunday = 7. Weekend is Saturday and Sunday in both.
    The bounds are one global aggregate (one row); the spine has one row per
    day, so it grows with the calendar span, not with the data.
    """
    bounds = orders.agg(
        F.min(F.to_date("order_purchase_at")).alias("start_date"),
        F.greatest(F.max(F.to_date("order_purchase_at")),
                   F.max(F.to_date("order_estimated_delivery_at"))).alias("end_date"),
    )
    spine = bounds.select(
        F.explode(F.sequence("start_date", "end_date", F.expr("INTERVAL 1 DAY"))).alias("date_day")
    )
    d = F.col("date_day")
    if week_start == "sunday":
        dow = F.dayofweek(d)
    elif week_start == "iso":
        dow = iso_day_of_week(d)
    else:
        raise ValueError(f"unknown week_start {week_start!r}")
    return spine.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d.alias("date_day"),
        F.year(d).alias("year_number"),
        F.quarter(d).alias("quarter_number"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_number"),
        dow.alias("day_of_week_number"),
        F.date_format(d, "EEEE").alias("day_of_week_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )


def _item_rollup(items: DataFrame, by_order: bool, apart: bool = False, store: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    if apart:
        # Each distinct count for itself: two in one aggregate send every line three times, with
        # places for the sums. Fewer bytes, more exchanges; a hot order is still spread by its keys.
        def distinct_count(of: str, alias: str) -> DataFrame:
            return items.select(F.col("order_id").alias(f"_{of}_order"), of).distinct().groupBy(f"_{of}_order").agg(F.count(of).alias(alias))

        orders = items.groupBy("order_id").agg(
            F.count(F.lit(1)).alias("item_count"),
            F.sum("item_price").alias("item_subtotal"),
            F.sum("freight_value").alias("freight_total"),
            F.sum(F.col("item_price") + F.col("freight_value")).alias("order_line_total"),
        )
        for of, alias in (("product_id", "distinct_product_count"), ("seller_id", "distinct_seller_count")):
            orders = orders.join(store(distinct_count(of, alias)), F.col("order_id") == F.col(f"_{of}_order"), "left").drop(f"_{of}_order")
        return orders
    if by_order:
        # The rows of an order are in one task: grouping twice keeps them there,
        # while two distinct counts in one aggregate would deal them anew.
        products = items.groupBy("order_id", "product_id").agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum("item_price").alias("_price"),
            F.sum("freight_value").alias("_freight"),
            F.sum(F.col("item_price") + F.col("freight_value")).alias("_total"),
        )
        sellers = items.select(F.col("order_id").alias("_s_order_id"), "seller_id").distinct().groupBy("_s_order_id").agg(
            F.count("seller_id").alias("distinct_seller_count"))
        orders = products.groupBy("order_id").agg(
            F.sum("_n").alias("item_count"),
            F.count("product_id").alias("distinct_product_count"),
            F.sum("_price").alias("item_subtotal"),
            F.sum("_freight").alias("freight_total"),
            F.sum("_total").alias("order_line_total"),
        )
        return orders.join(sellers, F.col("order_id") == F.col("_s_order_id"), "left").drop("_s_order_id")
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.count_distinct("product_id").alias("distinct_product_count"),
        F.count_distinct("seller_id").alias("distinct_seller_count"),
        F.sum("item_price").alias("item_subtotal"),
        F.sum("freight_value").alias("freight_total"),
        # NULL when either part is NULL, so skipped by the sum.
        F.sum(F.col("item_price") + F.col("freight_value")).alias("order_line_total"),
    )


def _payment_rollup(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("payment_count"),
        F.sum("payment_value").alias("payment_total"),
    )


def _review_rollup(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("review_count"),
        exact_avg("review_score", 2, precision=4).alias("average_review_score"),
    )


def fct_orders(orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame,
               by_order: bool = False, apart: bool = False, store: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """One row per order with item, payment and review rollups. ``by_order``: all
    four are stored in buckets of ``order_id``; then nothing is exchanged.
    ``apart``: the distinct counts of the lines are taken one by one. ``store`` is applied to
    each rollup: one that writes it lets the shuffles of one go before those of the next.

    Children are aggregated *before* the join (no fan-out), each rollup comes
    out hash-partitioned on ``order_id``, so the three left joins need only one
    more exchange (of orders). Missing rollups give 0 counts and 0.00 money;
    the review average stays NULL.
    """
    i = store(_item_rollup(items, by_order, apart, store)).withColumnRenamed("order_id", "_i_order_id")
    p = store(_payment_rollup(payments)).withColumnRenamed("order_id", "_p_order_id")
    r = store(_review_rollup(reviews)).withColumnRenamed("order_id", "_r_order_id")
    joined = (
        orders.join(i, orders["order_id"] == i["_i_order_id"], "left")
        .join(p, orders["order_id"] == p["_p_order_id"], "left")
        .join(r, orders["order_id"] == r["_r_order_id"], "left")
    )
    zero = F.lit(0)

    def money14(c: str):
        return F.coalesce(F.col(c), zero).cast("decimal(14,2)").alias(c)

    return joined.select(
        "order_id",
        "customer_id",
        "order_status",
        F.to_date("order_purchase_at").alias("order_purchase_date"),
        "order_purchase_at",
        "order_approved_at",
        "order_delivered_carrier_at",
        "order_delivered_customer_at",
        "order_estimated_delivery_at",
        F.coalesce("item_count", zero).alias("item_count"),
        F.coalesce("distinct_product_count", zero).alias("distinct_product_count"),
        F.coalesce("distinct_seller_count", zero).alias("distinct_seller_count"),
        money14("item_subtotal"),
        money14("freight_total"),
        money14("order_line_total"),
        F.coalesce("payment_count", zero).alias("payment_count"),
        money14("payment_total"),
        F.coalesce("review_count", zero).alias("review_count"),
        "average_review_score",
    )


def with_purchase_time(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines of known orders with their order's purchase time."""
    o = orders.select(F.col("order_id").alias("_o_order_id"), "order_purchase_at")
    return items.join(o, items["order_id"] == o["_o_order_id"], "inner")


def fct_order_items(items: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Order lines with their order's purchase date (inner join: lines of
    unknown orders drop out). Without ``orders`` the lines come from ``with_purchase_time``."""
    joined = items if orders is None else with_purchase_time(items, orders)
    return joined.select(
        "order_item_sk",
        "order_id",
        F.to_date("order_purchase_at").alias("order_purchase_date"),
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_at",
        "item_price",
        "freight_value",
        (F.col("item_price") + F.col("freight_value")).cast("decimal(14,2)").alias("order_line_total"),
    )
