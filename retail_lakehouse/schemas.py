"""Registry of the nine landing datasets and the ledger schemas.

Every landing column is a nullable string: typing happens in the silver
layer, never at read time, so a malformed value becomes NULL there instead of
failing the load.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Dataset:
    filename: str
    table_name: str
    columns: tuple[str, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType(), True) for c in self.columns])


# Landing file names, bronze table names and raw column names
# (including the source spelling "lenght") must equal the upstream dataset.
DATASETS: tuple[Dataset, ...] = (
    Dataset(
        "olist_orders_dataset.csv",
        "olist_orders",
        (
            "order_id",
            "customer_id",
            "order_status",
            "order_purchase_timestamp",
            "order_approved_at",
            "order_delivered_carrier_date",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
        ),
    ),
    Dataset(
        "olist_order_items_dataset.csv",
        "olist_order_items",
        (
            "order_id",
            "order_item_id",
            "product_id",
            "seller_id",
            "shipping_limit_date",
            "price",
            "freight_value",
        ),
    ),
    Dataset(
        "olist_order_payments_dataset.csv",
        "olist_order_payments",
        (
            "order_id",
            "payment_sequential",
            "payment_type",
            "payment_installments",
            "payment_value",
        ),
    ),
    Dataset(
        "olist_order_reviews_dataset.csv",
        "olist_order_reviews",
        (
            "review_id",
            "order_id",
            "review_score",
            "review_comment_title",
            "review_comment_message",
            "review_creation_date",
            "review_answer_timestamp",
        ),
    ),
    Dataset(
        "olist_customers_dataset.csv",
        "olist_customers",
        (
            "customer_id",
            "customer_unique_id",
            "customer_zip_code_prefix",
            "customer_city",
            "customer_state",
        ),
    ),
    Dataset(
        "olist_products_dataset.csv",
        "olist_products",
        (
            "product_id",
            "product_category_name",
            "product_name_lenght",
            "product_description_lenght",
            "product_photos_qty",
            "product_weight_g",
            "product_length_cm",
            "product_height_cm",
            "product_width_cm",
        ),
    ),
    Dataset(
        "olist_sellers_dataset.csv",
        "olist_sellers",
        (
            "seller_id",
            "seller_zip_code_prefix",
            "seller_city",
            "seller_state",
        ),
    ),
    Dataset(
        "olist_geolocation_dataset.csv",
        "olist_geolocation",
        (
            "geolocation_zip_code_prefix",
            "geolocation_lat",
            "geolocation_lng",
            "geolocation_city",
            "geolocation_state",
        ),
    ),
    Dataset(
        "product_category_name_translation.csv",
        "product_category_name_translation",
        (
            "product_category_name",
            "product_category_name_english",
        ),
    ),
)

BY_TABLE: dict[str, Dataset] = {d.table_name: d for d in DATASETS}
BY_FILE: dict[str, Dataset] = {d.filename: d for d in DATASETS}

# Accepted domains checked by the data-quality suite.
ORDER_STATUSES = (
    "approved",
    "canceled",
    "created",
    "delivered",
    "invoiced",
    "processing",
    "shipped",
    "unavailable",
)
REVIEW_SCORES = (1, 2, 3, 4, 5)
RUN_STATUSES = ("running", "succeeded", "failed")

LINEAGE_COLUMNS = ("_row_hash", "_source_file", "_batch_date", "_ingested_at", "_batch_id")

BRONZE_LINEAGE_SCHEMA = T.StructType(
    [
        T.StructField("_row_hash", T.StringType(), False),
        T.StructField("_source_file", T.StringType(), True),
        T.StructField("_batch_date", T.DateType(), True),
        T.StructField("_ingested_at", T.TimestampType(), True),
        T.StructField("_batch_id", T.StringType(), True),
    ]
)

RUN_LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.StringType(), False),
        T.StructField("batch_date", T.DateType(), True),
        T.StructField("status", T.StringType(), False),
        T.StructField("started_at", T.TimestampType(), True),
        T.StructField("finished_at", T.TimestampType(), True),
        T.StructField("row_counts", T.MapType(T.StringType(), T.LongType()), True),
        T.StructField("error_message", T.StringType(), True),
        T.StructField("recorded_at", T.TimestampType(), True),
    ]
)

FILE_LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("source_file", T.StringType(), False),
        T.StructField("sha256", T.StringType(), False),
        T.StructField("row_count", T.LongType(), True),
        T.StructField("inserted_row_count", T.LongType(), True),
        T.StructField("loaded_at", T.TimestampType(), True),
    ]
)
