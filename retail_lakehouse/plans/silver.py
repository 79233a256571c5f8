"""Silver: typed, cleaned, source-grain tables (SV-1 … SV-9).

Each function takes the bronze DataFrame of one dataset (landing string
columns plus ``_row_hash``, ``_batch_date``, ``_ingested_at``) and returns the
cleaned table. Blank strings become NULL and casts are tolerant (a bad value is
NULL, never an error). Only the review window, the geolocation group and the
translation dedup shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lakehouse.functions.columns import blank_to_null, exact_avg, surrogate_key, try_type
from retail_lakehouse.operators.rows import latest_version

MONEY = "decimal(12,2)"
COORD = "decimal(18,8)"


def _lineage() -> list:
    return [
        F.col("_row_hash").alias("source_row_hash"),
        F.col("_batch_date").alias("batch_date"),
        F.col("_ingested_at").alias("ingested_at"),
    ]


def _text(name: str, alias: str | None = None):
    return blank_to_null(name).alias(alias or name)


def _typed(name: str, data_type: str, alias: str | None = None):
    return try_type(name, data_type).alias(alias or name)


def silver_orders(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        *_lineage(),
        _text("order_id"),
        _text("customer_id"),
        _text("order_status"),
        _typed("order_purchase_timestamp", "timestamp", "order_purchase_at"),
        _typed("order_approved_at", "timestamp"),
        _typed("order_delivered_carrier_date", "timestamp", "order_delivered_carrier_at"),
        _typed("order_delivered_customer_date", "timestamp", "order_delivered_customer_at"),
        _typed("order_estimated_delivery_date", "timestamp", "order_estimated_delivery_at"),
    )


def order_item_columns(key_algo: str = "sha256", lineage: bool = True) -> list:
    # The surrogate key hashes the raw strings, before blank -> NULL.
    return [
        surrogate_key(["order_id", "order_item_id"], key_algo).alias("order_item_sk"),
        *(_lineage() if lineage else []),
        _text("order_id"),
        _typed("order_item_id", "int"),
        _text("product_id"),
        _text("seller_id"),
        _typed("shipping_limit_date", "timestamp", "shipping_limit_at"),
        _typed("price", MONEY, "item_price"),
        _typed("freight_value", MONEY),
    ]


def silver_order_items(bronze: DataFrame, key_algo: str = "sha256") -> DataFrame:
    return bronze.select(*order_item_columns(key_algo))


def silver_order_payments(bronze: DataFrame, key_algo: str = "sha256") -> DataFrame:
    return bronze.select(
        surrogate_key(["order_id", "payment_sequential"], key_algo).alias("payment_sk"),
        *_lineage(),
        _text("order_id"),
        _typed("payment_sequential", "int", "payment_sequence"),
        _text("payment_type"),
        _typed("payment_installments", "int"),
        _typed("payment_value", MONEY),
    )


def silver_order_reviews(bronze: DataFrame) -> DataFrame:
    """Latest version of each review: answered last (unanswered after all
    answered ones), then ingested last, then smallest row hash."""
    typed = bronze.select(
        *_lineage(),
        _text("review_id"),
        _text("order_id"),
        _typed("review_score", "int"),
        _text("review_comment_title"),
        _text("review_comment_message"),
        _typed("review_creation_date", "timestamp", "review_created_at"),
        _typed("review_answer_timestamp", "timestamp", "review_answered_at"),
    )
    return latest_version(
        typed,
        "review_id",
        [
            F.col("review_answered_at").desc_nulls_last(),
            F.col("ingested_at").desc_nulls_last(),
            F.col("source_row_hash").asc_nulls_last(),
        ],
    )


def silver_customers(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        *_lineage(),
        _text("customer_id"),
        _text("customer_unique_id"),
        _typed("customer_zip_code_prefix", "int", "zip_code_prefix"),
        _text("customer_city"),
        _text("customer_state"),
    )


def silver_products(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        *_lineage(),
        _text("product_id"),
        _text("product_category_name"),
        _typed("product_name_lenght", "int", "product_name_length"),
        _typed("product_description_lenght", "int", "product_description_length"),
        _typed("product_photos_qty", "int", "product_photos_quantity"),
        _typed("product_weight_g", MONEY),
        _typed("product_length_cm", MONEY),
        _typed("product_height_cm", MONEY),
        _typed("product_width_cm", MONEY),
    )


def silver_sellers(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        *_lineage(),
        _text("seller_id"),
        _typed("seller_zip_code_prefix", "int", "zip_code_prefix"),
        _text("seller_city"),
        _text("seller_state"),
    )


def silver_geolocation(bronze: DataFrame) -> DataFrame:
    """One row per zip prefix (NULL is a group of its own): exact average of
    the coordinates at the scale Spark gives ``avg(decimal(18,8))`` —
    ``decimal(22,12)`` — and the greatest city and state name.

    The averages are algebraic (sum and count), so a zip holding a third of
    all rows is pre-aggregated in every map task before the shuffle.
    """
    typed = bronze.select(
        _typed("geolocation_zip_code_prefix", "int", "zip_code_prefix"),
        _typed("geolocation_lat", COORD, "latitude"),
        _typed("geolocation_lng", COORD, "longitude"),
        _text("geolocation_city", "city"),
        _text("geolocation_state", "state"),
    )
    return typed.groupBy("zip_code_prefix").agg(
        exact_avg("latitude", 12, input_scale=8, precision=22).alias("latitude"),
        exact_avg("longitude", 12, input_scale=8, precision=22).alias("longitude"),
        F.max("city").alias("city"),
        F.max("state").alias("state"),
    )


def silver_category_translation(bronze: DataFrame) -> DataFrame:
    """One row per category name; the smallest English name wins, so the
    survivor is the same on every run."""
    typed = bronze.select(
        _text("product_category_name"),
        _text("product_category_name_english"),
    )
    return typed.groupBy("product_category_name").agg(
        F.min("product_category_name_english").alias("product_category_name_english")
    )


SILVER_BUILDERS = {
    "orders": ("olist_orders", silver_orders),
    "order_items": ("olist_order_items", silver_order_items),
    "order_payments": ("olist_order_payments", silver_order_payments),
    "order_reviews": ("olist_order_reviews", silver_order_reviews),
    "customers": ("olist_customers", silver_customers),
    "products": ("olist_products", silver_products),
    "sellers": ("olist_sellers", silver_sellers),
    "geolocation": ("olist_geolocation", silver_geolocation),
    "product_category_translation": ("product_category_name_translation", silver_category_translation),
}
