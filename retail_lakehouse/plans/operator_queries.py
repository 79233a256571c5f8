"""Queries that run the landing, ingest, stream and check operators on the
snapshot: ``(spark, sf_dir) -> DataFrame``. What they write goes to new folders
under the shared checkpoint folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lakehouse.functions.columns import row_hash
from retail_lakehouse.operators import quality as Q
from retail_lakehouse.operators.ntile import distributed_ntile
from retail_lakehouse.operators.rows import dedupe_rows
from retail_lakehouse.operators.slice import daily_slice, orders_summary, rows_digest, slice_digest, zip_codes
from retail_lakehouse.plans import ingest as I
from retail_lakehouse.plans.build import build_all
from retail_lakehouse.plans.distinct_states import add_batch, distinct_by_period, read_states
from retail_lakehouse.plans.incremental import build_new_days, read_built
from retail_lakehouse.plans.layers import Lakehouse
from retail_lakehouse.schemas import BY_TABLE, DATASETS
from retail_lakehouse.session import drop_materialized, ensure_checkpoint_dir, materialize, new_table_path, shuffles_dropped
from retail_lakehouse.sources import driver_tables as D
from retail_lakehouse.sources.landing import drop_folder, ensure_layers, missing_files, write_csv_counted, write_daily_slice
from retail_lakehouse.sources.stored import read_table, write_layer
from retail_lakehouse.streaming.bronze_stream import stream_bronze

FIRST_DAY, SECOND_DAY = "2026-01-01", "2026-01-02"
ORDERS, CUSTOMERS = "olist_orders", "olist_customers"


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _raw(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    t = D.load_driver_tables(spark, sf)
    return {d.table_name: D.raw_table(t, d.table_name) for d in DATASETS}


def _first_day(tables: Mapping[str, DataFrame]):
    return orders_summary(tables[ORDERS]).first()["first_order_date"]


def daily_slice_digest(spark: SparkSession, sf: str) -> DataFrame:
    """The first day's slice of all nine tables."""
    tables = _raw(spark, sf)
    return slice_digest(tables, _first_day(tables))


def daily_batch_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """The same slice written as landing CSV, loaded as a day and read back
    from bronze: (table_name, row_hash, batch_date)."""
    tables, landing, bronze = _raw(spark, sf), _folder(spark, "landing"), _folder(spark, "bronze")
    day = _first_day(tables)
    write_daily_slice(daily_slice(tables, day), landing, day)
    I.ingest_batch(spark, landing, bronze, day)
    return _bronze_digest(spark, bronze)


# Which rows land on the first of two days already: by the parity of a column.
_BY_KEY = {
    ORDERS: "order_id", "olist_order_items": "order_id", "olist_order_payments": "order_id",
    "olist_order_reviews": "review_id",  # the versions of a review land together
    CUSTOMERS: "customer_id", "olist_products": "product_id", "olist_sellers": "seller_id",
    "olist_geolocation": "geolocation_zip_code_prefix",
}
FIRST_LANDED = {t: f"CAST({key} AS BIGINT) % 2 = 0" for t, key in _BY_KEY.items()} | {
    "product_category_name_translation": "length(product_category_name) % 2 = 0"}


def _two_days(spark: SparkSession, sf: str, landing: str) -> Iterator[str]:
    """All nine tables landed on two days, the first rows of each, then all rows: each day when it has landed."""
    raw = _raw(spark, sf)
    # Those that are joined or grouped are so once for both days.
    stored = {t: new_table_path(spark, f"raw-{t}") for t in (ORDERS, "olist_order_payments")}

    def write(d, day: str) -> None:
        if day == FIRST_DAY and d.table_name in stored:
            raw[d.table_name] = materialize(raw[d.table_name], compression="zstd", path=stored[d.table_name])
        rows = raw[d.table_name]
        write_csv_counted(rows.where(F.expr(FIRST_LANDED[d.table_name])) if day == FIRST_DAY else rows, f"{landing}/{day}/{d.filename}", "gzip")

    for day in (FIRST_DAY, SECOND_DAY):
        with shuffles_dropped(spark), ThreadPoolExecutor(max_workers=4) as pool:
            list(pool.map(write, DATASETS, [day] * len(DATASETS)))
        if day == SECOND_DAY:
            drop_materialized(spark, stored.values())
        yield day


def _write_two_days(spark: SparkSession, sf: str) -> str:
    """All nine tables landed on two days. The landing folder; the caller drops it when its files are loaded."""
    landing = _folder(spark, "landing")
    for _ in _two_days(spark, sf, landing):
        pass
    return landing


def _bronze_digest(spark: SparkSession, bronze: str) -> DataFrame:
    """Every row of all nine bronze tables: (table_name, row_hash, batch_date)."""
    parts = [I.read_bronze(spark, bronze, d.table_name).select(
        F.lit(d.table_name).alias("table_name"), F.col("_row_hash").alias("row_hash"), F.col("_batch_date").alias("batch_date")) for d in DATASETS]
    return reduce(DataFrame.unionByName, parts)


def scan_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """All tables landed on two days, loaded by two scans: every row once, with the day it landed first."""
    landing, bronze = _write_two_days(spark, sf), _folder(spark, "bronze")
    for _ in range(2):
        I.ingest_bronze(spark, landing, bronze)
    drop_folder(spark, landing)
    return _bronze_digest(spark, bronze)


def ingest_ledgers(spark: SparkSession, sf: str) -> DataFrame:
    """What the ledgers hold after two scans of all tables landed on two days:
    (ledger, state, rows): runs by status, rows read and inserted by loaded files of each table."""
    landing, bronze = _write_two_days(spark, sf), _folder(spark, "bronze")
    for _ in range(2):
        I.ingest_bronze(spark, landing, bronze)
    runs = I.latest_runs(spark, bronze).groupBy(F.col("status").alias("state")).agg(F.count(F.lit(1)).alias("rows"))
    # The files of one run and table share its counts.
    loaded = I.file_ledger(spark, bronze).select("batch_id", "table_name", "row_count", "inserted_row_count").distinct()
    files = loaded.select("table_name", F.explode(F.map_from_arrays(
        F.array(F.lit("read"), F.lit("inserted")), F.array("row_count", "inserted_row_count"))).alias("state", "rows"))
    state = F.concat("table_name", F.lit("."), "state")
    return runs.select(F.lit("runs").alias("ledger"), "state", "rows").unionByName(
        files.groupBy(F.lit("files").alias("ledger"), state.alias("state")).agg(F.sum("rows").alias("rows")))


def streamed_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """All tables landed on two days, loaded by nine concurrent streams (run
    twice) and a scan after them, which finds nothing new."""
    landing, bronze, state = _write_two_days(spark, sf), _folder(spark, "bronze"), _folder(spark, "stream-state")
    for _ in range(2):
        stream_bronze(spark, landing, bronze, state)
    I.ingest_bronze(spark, landing, bronze)
    for folder in (landing, state):
        drop_folder(spark, folder)
    return _bronze_digest(spark, bronze)


def deduped_landings(spark: SparkSession, sf: str) -> DataFrame:
    """Orders that landed on two days: one row per content, the earlier day kept."""
    d, raw = BY_TABLE[ORDERS], _raw(spark, sf)[ORDERS]
    hashed = raw.select(*d.columns, row_hash(d.columns).alias("_row_hash"))
    later = hashed.withColumn("_batch_date", F.lit(SECOND_DAY).cast("date")).withColumn("_source_file", F.lit("a"))
    earlier = hashed.withColumn("_batch_date", F.lit(FIRST_DAY).cast("date")).withColumn("_source_file", F.lit("b"))
    return dedupe_rows(later.unionByName(earlier))


def inserted_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Customers that a table holding those with even keys does not have yet."""
    d, raw = BY_TABLE[CUSTOMERS], _raw(spark, sf)[CUSTOMERS]
    source = raw.distinct().select(*d.columns, row_hash(d.columns).alias("_row_hash"))
    target = source.where(F.col("customer_id").cast("bigint") % 2 == 0)
    return I.insert_new_rows(target, source)


def event_ntiles(spark: SparkSession, sf: str) -> DataFrame:
    """Deciles of all events by value, and reversed quintiles."""
    e = D.load_driver_tables(spark, sf)["events"].select("event_id", "value")
    order = ["value", "event_id"]
    both = distributed_ntile(distributed_ntile(e, 10, order, "decile"), 5, order, "reversed_quintile", reverse=True)
    return both.select("event_id", "decile", "reversed_quintile")


def slice_zips(spark: SparkSession, sf: str) -> DataFrame:
    t = _raw(spark, sf)
    return zip_codes(t[CUSTOMERS], t["olist_sellers"])


def failing_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The failing rows or values of one check of each kind: (check, value, records)."""
    lh = Lakehouse.from_driver(spark, sf)
    reviews, orders, customers, items = lh.silver("order_reviews"), lh.silver("orders"), lh.silver("customers"), lh.silver("order_items")

    def rows(name: str, df: DataFrame, key: str) -> DataFrame:
        return df.groupBy(F.col(key).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("check"), "value", "records")

    def values(name: str, df: DataFrame, key: str) -> DataFrame:
        return df.select(F.lit(name).alias("check"), F.col(key).cast("string").alias("value"), F.col("n_records").alias("records"))

    return (
        rows("not_null", Q.not_null(reviews, "review_answered_at"), "review_id")
        .unionByName(values("unique", Q.unique(customers, "customer_unique_id"), "customer_unique_id"))
        .unionByName(rows("relationships", Q.relationships(reviews, "order_id", orders, "order_id"), "order_id"))
        .unionByName(values("orphan_keys", Q.orphan_keys(reviews, "order_id", orders, "order_id"), "order_id"))
        .unionByName(values("accepted_values", Q.accepted_values(orders, "order_status", ["delivered"]), "order_status"))
        .unionByName(rows("non_negative", Q.non_negative(items.withColumn("change", F.col("freight_value") - 500), ["change"]), "order_id"))
    )


def run_status_domain(spark: SparkSession, sf: str) -> DataFrame:
    """Order states read as if they were the states of a stored run ledger."""
    orders = _raw(spark, sf)[ORDERS]
    ledger = orders.select(F.col("order_id").alias("batch_id"), F.when(F.col("order_status") == "delivered", F.lit("succeeded"))
                           .when(F.col("order_status") == "shipped", F.lit("paused")).alias("status"))
    return I.invalid_run_statuses(ledger)


def landing_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Of the first day's slice, only the files that would hold rows are
    written: (filename, present) of all nine, from the file system."""
    tables, landing = _raw(spark, sf), _folder(spark, "landing")
    day = _first_day(tables)
    sliced = daily_slice(tables, day)
    held = {r["table_name"] for r in rows_digest(sliced).select("table_name").distinct().collect()}
    for d in DATASETS:
        if d.table_name in held:
            write_csv_counted(sliced[d.table_name].select(*d.columns), f"{landing}/{day}/{d.filename}")
    missing = set(missing_files(spark, f"{landing}/{day}"))
    return spark.createDataFrame([(d.filename, d.filename not in missing) for d in DATASETS], "filename string, present boolean")


def stored_layer(spark: SparkSession, sf: str) -> DataFrame:
    """A dimension written as a layer and read back."""
    root = _folder(spark, "layers")
    ensure_layers(spark, "retail_gold")
    write_layer(Lakehouse.from_driver(spark, sf).gold("dim_customers"), f"{root}/dim_customers")
    return read_table(spark, root, "dim_customers")


def built_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Every layer built, written and checked: rows per table, failing rows per check."""
    root = _folder(spark, "lake")
    out = build_all(spark, Lakehouse.from_driver(spark, sf), root)
    rows = spark.createDataFrame(sorted(out["rows"].items()), "table_name string, row_count long")
    return rows.unionByName(read_table(spark, root, "quality/checks").select(
        F.concat(F.lit("check."), "check_name").alias("table_name"), F.col("failing_rows").alias("row_count")))


def incremental_build(spark: SparkSession, sf: str) -> DataFrame:
    """All tables landed on two days, each loaded and built as it comes (what has been loaded
    is not kept as landing files): the daily sales as stored."""
    landing, bronze, root = (_folder(spark, name) for name in ("landing", "bronze", "incremental"))
    for day in _two_days(spark, sf, landing):
        I.ingest_batch(spark, landing, bronze, day)
        drop_folder(spark, f"{landing}/{day}")
        build_new_days(spark, bronze, root, grain="month")
    return read_built(spark, root, "mart_daily_sales")


def distinct_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with orders by day, month, year and in all, (grain, period, customer_count), from daily
    states of distinct customers that two batches of the order fact were added to."""
    root = _folder(spark, "customer-states")
    orders = materialize(Lakehouse.from_driver(spark, sf).gold("fct_orders").select("order_id", "order_purchase_date", "customer_id"), "order-customers")
    for batch, rows in enumerate((orders.where(FIRST_LANDED[ORDERS]), orders.where(f"NOT coalesce({FIRST_LANDED[ORDERS]}, false)"))):
        add_batch(rows, root, str(batch), "customer_id", ["order_purchase_date"])
    return distinct_by_period(read_states(spark, root, ["order_purchase_date"]), "order_purchase_date", "customer_count")


QUERIES = {
    "distinct_customers": distinct_customers,
    "incremental_build": incremental_build,
    "daily_slice_digest": daily_slice_digest,
    "daily_batch_bronze": daily_batch_bronze,
    "scan_bronze": scan_bronze,
    "ingest_ledgers": ingest_ledgers,
    "streamed_bronze": streamed_bronze,
    "deduped_landings": deduped_landings,
    "inserted_rows": inserted_rows,
    "event_ntiles": event_ntiles,
    "slice_zips": slice_zips,
    "failing_rows": failing_rows,
    "run_status_domain": run_status_domain,
    "landing_inventory": landing_inventory,
    "stored_layer": stored_layer,
    "built_layers": built_layers,
}
