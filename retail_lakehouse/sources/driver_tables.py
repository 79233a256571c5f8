"""Derive the nine landing-shaped inputs from the star-schema parquet tables.

The analytics layers expect the nine retail landing files (all-string
columns). The benchmark data is a TPC-H-like star schema, so this module maps
it onto that shape, entirely with DataFrame expressions:

==================  ==========================================================
landing dataset     derivation
==================  ==========================================================
orders              ``orders``; status F/O/P -> delivered/shipped/processing;
                    carrier date = first line ship date, customer delivery =
                    last line ship date (delivered orders only), estimate =
                    order date + 45 days
order_items         ``lineitem``: item id = line number, price = extended
                    price, freight = price x tax (decimal, half up)
order_payments      one per (order, return flag): value = sum(price + freight),
                    sequence = rank of the flag inside the order
order_reviews       ``events``: review = event_id div 2 (two versions each),
                    order = event_id div 3, score = 1 + event_id mod 5;
                    'error' events have no answer time
customers           ``customer``: person = custkey div 2, zip = nation key,
                    city = nation, state = region
products            ``part``: category = lower(p_type)
sellers             ``supplier``: zip = nation key, city/state as customers
geolocation         one row per customer and per supplier at its nation
category names      the English names of four of the six part types; the
                    other two fall back to the original name
==================  ==========================================================

A missing value is the empty string, as in the landing CSV written by the
replay: cleaning turns it into NULL. Lineage of the whole snapshot is one
batch (``SNAPSHOT``): a constant source name per table, batch date and
ingest time, so every derived table is reproducible.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from retail_lakehouse.functions.columns import blank_to_null, row_hash
from retail_lakehouse.schemas import BY_TABLE
from retail_lakehouse.session import input_bytes, prepare, size_shuffles_of_columns

SNAPSHOT_DATE = date(2026, 1, 1)
ESTIMATE_DAYS = 45

STATUS_BY_CODE = {"F": "delivered", "O": "shipped", "P": "processing"}
PAYMENT_TYPE_BY_FLAG = {"A": "credit_card", "N": "boleto", "R": "voucher"}
CATEGORY_TRANSLATIONS = {"economy": "budget", "large": "bulky", "medium": "standard_size", "promo": "promotion"}

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


# Declared schemas of the star-schema tables: no footer-reading job to infer
# them, and a changed file fails loudly instead of flowing through.
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def load_driver_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star-schema tables, with shuffle partitions sized from their total
    file size unless the session already chose a count."""
    prepare(spark)
    paths = {t: f"{sf_dir}/{t}.parquet" for t in DRIVER_TABLES}
    size_shuffles_of_columns(spark, input_bytes(spark, paths.values()))
    return {t: spark.read.schema(DRIVER_SCHEMAS[t]).parquet(p) for t, p in paths.items()}


def ts_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _idiv(c: Column, k: int) -> Column:
    return F.call_function("div", c, F.lit(k))


def _blank_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _case_map(c: Column, mapping: dict[str, str]) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out.otherwise(F.lit(""))


def _decimal_text(c: Column, precision: int = 12, scale: int = 2) -> Column:
    return c.cast(f"decimal({precision},{scale})").cast("string")


def _geo(t: dict[str, DataFrame]) -> DataFrame:
    # No broadcast hint: the planner broadcasts nation and region (25 and 5
    # rows in TPC-H) only while their size statistic is under
    # spark.sql.autoBroadcastJoinThreshold, and AQE re-checks it from the
    # runtime size; a larger table would be shuffled instead.
    return (
        t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )


def _seconds(c: Column) -> Column:
    """The landing text keeps whole seconds, so rows are told apart by them."""
    return F.date_trunc("SECOND", c).cast("timestamp_ntz")


def orders_by_type(t: dict[str, DataFrame]) -> DataFrame:
    """The order rows before they become text: all that the text depends on."""
    ship_span = t["lineitem"].groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")
    )
    o = t["orders"]
    joined = o.join(ship_span, o["o_orderkey"] == ship_span["l_orderkey"], "left")
    return joined.select(
        "o_orderkey", "o_custkey", _case_map(F.col("o_orderstatus"), STATUS_BY_CODE).alias("status"),
        F.coalesce(F.col("o_orderstatus") != "P", F.lit(False)).alias("approved"),
        _seconds(F.col("o_orderdate")).alias("ordered"), _seconds(F.col("first_ship")).alias("first_ship"),
        _seconds(F.col("last_ship")).alias("last_ship"),
    )


def orders_text(o: DataFrame) -> DataFrame:
    def when(condition: Column, c: str) -> Column:
        return F.when(condition, _blank_if_null(ts_text(F.col(c)))).otherwise(F.lit(""))

    return o.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("status").alias("order_status"),
        ts_text(F.col("ordered")).alias("order_purchase_timestamp"),
        F.when(F.col("approved"), ts_text(F.col("ordered"))).otherwise(F.lit("")).alias("order_approved_at"),
        when(F.col("approved"), "first_ship").alias("order_delivered_carrier_date"),
        when(F.col("status") == STATUS_BY_CODE["F"], "last_ship").alias("order_delivered_customer_date"),
        ts_text(F.date_add("ordered", ESTIMATE_DAYS).cast("timestamp_ntz")).alias("order_estimated_delivery_date"),
    )


def raw_orders(t: dict[str, DataFrame]) -> DataFrame:
    return orders_text(orders_by_type(t))


def _item_amounts(li: DataFrame) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    tax = F.col("l_tax").cast("decimal(4,2)")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag",
        price.alias("price"),
        (price * tax).cast("decimal(12,2)").alias("freight"),
    )


def items_by_type(t: dict[str, DataFrame]) -> DataFrame:
    return _item_amounts(t["lineitem"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", _seconds(F.col("l_shipdate")).alias("shipped"), "price", "freight")


def items_text(li: DataFrame) -> DataFrame:
    return li.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("string").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        ts_text(F.col("shipped")).alias("shipping_limit_date"),
        F.col("price").cast("string").alias("price"),
        F.col("freight").cast("string").alias("freight_value"),
    )


def raw_order_items(t: dict[str, DataFrame]) -> DataFrame:
    return items_text(items_by_type(t))


def raw_order_payments(t: dict[str, DataFrame]) -> DataFrame:
    li = _item_amounts(t["lineitem"])
    per_flag = li.groupBy("l_orderkey", "l_returnflag").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.col("price") + F.col("freight")).alias("value"),
    )
    # At most three flags per order, so each window partition is tiny.
    seq = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_returnflag"))
    return per_flag.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        seq.cast("string").alias("payment_sequential"),
        _case_map(F.col("l_returnflag"), PAYMENT_TYPE_BY_FLAG).alias("payment_type"),
        F.col("lines").cast("string").alias("payment_installments"),
        _decimal_text(F.col("value")).alias("payment_value"),
    )


def raw_order_reviews(t: dict[str, DataFrame]) -> DataFrame:
    e = t["events"]
    answered = F.when(F.col("event_type") == "error", F.lit("")).otherwise(
        ts_text(F.col("ts") + F.expr("INTERVAL 1 DAY"))
    )
    return e.select(
        _idiv(F.col("event_id"), 2).cast("string").alias("review_id"),
        _idiv(F.col("event_id"), 3).cast("string").alias("order_id"),
        (F.lit(1) + F.pmod(F.col("event_id"), F.lit(5))).cast("string").alias("review_score"),
        _blank_if_null(F.col("event_type")).alias("review_comment_title"),
        _blank_if_null(F.col("props")).alias("review_comment_message"),
        ts_text(F.col("ts")).alias("review_creation_date"),
        answered.alias("review_answer_timestamp"),
    )


def raw_customers(t: dict[str, DataFrame]) -> DataFrame:
    c = t["customer"].join(_geo(t), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return c.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        _idiv(F.col("c_custkey"), 2).cast("string").alias("customer_unique_id"),
        F.col("c_nationkey").cast("string").alias("customer_zip_code_prefix"),
        _blank_if_null(F.col("n_name")).alias("customer_city"),
        _blank_if_null(F.col("r_name")).alias("customer_state"),
    )


def raw_products(t: dict[str, DataFrame]) -> DataFrame:
    p = t["part"]
    return p.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        _blank_if_null(F.lower(F.col("p_type"))).alias("product_category_name"),
        F.length(F.col("p_name")).cast("string").alias("product_name_lenght"),
        (F.length(F.col("p_brand")) * 10).cast("string").alias("product_description_lenght"),
        (F.pmod(F.col("p_size"), F.lit(5)) + 1).cast("string").alias("product_photos_qty"),
        _decimal_text(F.col("p_retailprice")).alias("product_weight_g"),
        _decimal_text(F.col("p_size")).alias("product_length_cm"),
        _decimal_text(F.col("p_size") * F.lit(0.5).cast("decimal(2,1)")).alias("product_height_cm"),
        _decimal_text(F.col("p_size") * F.lit(0.25).cast("decimal(3,2)")).alias("product_width_cm"),
    )


def raw_sellers(t: dict[str, DataFrame]) -> DataFrame:
    s = t["supplier"].join(_geo(t), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return s.select(
        F.col("s_suppkey").cast("string").alias("seller_id"),
        F.col("s_nationkey").cast("string").alias("seller_zip_code_prefix"),
        _blank_if_null(F.col("n_name")).alias("seller_city"),
        _blank_if_null(F.col("r_name")).alias("seller_state"),
    )


def raw_geolocation(t: dict[str, DataFrame]) -> DataFrame:
    geo = _geo(t)

    def points(df: DataFrame, nation: str, bal: str) -> DataFrame:
        return df.join(geo, F.col(nation) == F.col("n_nationkey"), "left").select(
            F.col(nation).cast("string").alias("geolocation_zip_code_prefix"),
            _decimal_text(F.col(bal).cast("decimal(12,2)") * F.lit(0.01).cast("decimal(3,2)"), 18, 8).alias("geolocation_lat"),
            _decimal_text(F.col(bal).cast("decimal(12,2)") * F.lit(-0.001).cast("decimal(4,3)"), 18, 8).alias("geolocation_lng"),
            _blank_if_null(F.col("n_name")).alias("geolocation_city"),
            _blank_if_null(F.col("r_name")).alias("geolocation_state"),
        )

    return points(t["customer"], "c_nationkey", "c_acctbal").unionByName(
        points(t["supplier"], "s_nationkey", "s_acctbal")
    )


def raw_category_translation(t: dict[str, DataFrame]) -> DataFrame:
    """English names for the product categories. The category list is read
    from ``part`` (distinct after a partial aggregate, so at most one row per
    type), then mapped through the fixed translation table."""
    cats = t["part"].select(F.lower(F.col("p_type")).alias("product_category_name")).distinct()
    english = _case_map(F.col("product_category_name"), CATEGORY_TRANSLATIONS)
    return cats.select("product_category_name", english.alias("product_category_name_english")).where(
        F.col("product_category_name_english") != ""
    )


RAW_BUILDERS = {
    "olist_orders": raw_orders,
    "olist_order_items": raw_order_items,
    "olist_order_payments": raw_order_payments,
    "olist_order_reviews": raw_order_reviews,
    "olist_customers": raw_customers,
    "olist_products": raw_products,
    "olist_sellers": raw_sellers,
    "olist_geolocation": raw_geolocation,
    "product_category_name_translation": raw_category_translation,
}

SOURCE_TABLE = {
    "olist_orders": "orders",
    "olist_order_items": "lineitem",
    "olist_order_payments": "lineitem",
    "olist_order_reviews": "events",
    "olist_customers": "customer",
    "olist_products": "part",
    "olist_sellers": "supplier",
    "olist_geolocation": "customer+supplier",
    "product_category_name_translation": "part",
}


def raw_table(t: dict[str, DataFrame], table_name: str) -> DataFrame:
    return RAW_BUILDERS[table_name](t)


def with_snapshot_lineage(raw: DataFrame, table_name: str, layout: str = "struct") -> DataFrame:
    """Landing columns plus the bronze lineage columns for the one snapshot
    batch; ``_row_hash`` is the content fingerprint of the landing columns."""
    cols = BY_TABLE[table_name].columns
    return raw.select(
        *cols,
        row_hash(cols, layout).alias("_row_hash"),
        F.lit(f"{SOURCE_TABLE[table_name]}.parquet").alias("_source_file"),
        F.lit(SNAPSHOT_DATE).alias("_batch_date"),
        F.lit(SNAPSHOT_DATE).cast("timestamp").alias("_ingested_at"),
        F.lit(f"snapshot-{SNAPSHOT_DATE.isoformat()}").alias("_batch_id"),
    )


# Rows that are made distinct on typed columns (8-byte keys, dates, decimals)
# and become text afterwards; a table's text is one-to-one with these.
TYPED = {
    "olist_orders": (orders_by_type, orders_text),
    "olist_order_items": (items_by_type, items_text),
}
# One row per group of its own key: distinct as built.
DISTINCT_AS_BUILT = {"olist_order_payments", "product_category_name_translation"}


def distinct_raw(t: dict[str, DataFrame], table_name: str) -> DataFrame:
    """The landing rows of the snapshot, each content once."""
    if table_name in DISTINCT_AS_BUILT:
        return raw_table(t, table_name)
    if table_name in TYPED:
        typed, text = TYPED[table_name]
        return text(typed(t).distinct())
    return raw_table(t, table_name).distinct()


def snapshot_bronze(t: dict[str, DataFrame], table_name: str, layout: str = "struct") -> DataFrame:
    """Bronze table of the snapshot: one row per distinct landing row.

    Every row of the snapshot carries the same lineage, so rows with equal
    content hash are equal in every column and "keep the earliest" is plain
    ``distinct`` — a hash aggregate with a map-side partial instead of a sort
    on the 64-character hash. The hash is added after the dedup, so queries
    that never read ``source_row_hash`` do not compute it at all.
    """
    return with_snapshot_lineage(distinct_raw(t, table_name), table_name, layout)


def dealt_bronze(t: dict[str, DataFrame], table_name: str, buckets: int) -> DataFrame:
    """``snapshot_bronze`` dealt by ``order_id`` into ``buckets`` as a stored table is. The rows move
    before they get their hashes, which hold more bytes than all their other columns."""
    order_id = blank_to_null("order_id")
    return with_snapshot_lineage(distinct_raw(t, table_name).repartition(buckets, order_id), table_name)


def snapshot_landing(t: dict[str, DataFrame], table_name: str) -> DataFrame:
    """The landing rows with lineage, copies included: for steps that keep one
    row per key anyway."""
    return with_snapshot_lineage(raw_table(t, table_name), table_name)
