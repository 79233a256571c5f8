"""Daily slices of the landing tables (SL-1 … SL-6, SO-1) and the whole replay
plan.

A daily slice is the referentially complete subset of the nine landing tables
for one purchase date: that day's orders, their items, payments and reviews,
the customers, products and sellers they reference, the category names of
those products and the geolocation rows of every customer or seller zip.
Keys are compared null-safely (``<=>``), so a blank key matches a blank key,
as set membership on the landing text does.

``replay_plan`` computes the row counts of *every* day's slice at once: every
key carries the set of its days, so no row is copied once per day.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_lakehouse.functions.columns import row_hash
from retail_lakehouse.operators.rows import left_semi
from retail_lakehouse.session import materialize

ORDERS = "olist_orders"
ITEMS = "olist_order_items"
PAYMENTS = "olist_order_payments"
REVIEWS = "olist_order_reviews"
CUSTOMERS = "olist_customers"
PRODUCTS = "olist_products"
SELLERS = "olist_sellers"
GEO = "olist_geolocation"
CATEGORIES = "product_category_name_translation"


class SourceDataError(ValueError):
    """Missing or malformed source data."""


PURCHASED = "order_purchase_timestamp"


def bad_purchase_times() -> Column:
    """Aggregate: rows whose purchase timestamp is blank or does not parse."""
    return F.count_if(F.expr(f"try_to_timestamp(nullif({PURCHASED}, ''))").isNull())


def purchase_date(orders: DataFrame) -> Column:
    """Date of the purchase timestamp text. Strict: a blank or malformed
    timestamp, its time of day included, fails the job."""
    when = F.expr(f"try_to_timestamp(nullif({PURCHASED}, ''))")
    wrong = F.concat(F.lit("Orders contain an invalid purchase timestamp: "), F.coalesce(PURCHASED, F.lit("")))
    return F.to_date(F.coalesce(when, F.raise_error(wrong).cast("timestamp")))


# --- one day -------------------------------------------------------------------

def slice_orders(orders: DataFrame, batch_date: date | str) -> DataFrame:
    return orders.where(purchase_date(orders) == F.lit(batch_date).cast("date"))


def slice_children(child: DataFrame, orders: DataFrame) -> DataFrame:
    return left_semi(child, orders, "order_id", null_safe=True)


def slice_parents(t: Mapping[str, DataFrame], orders: DataFrame, items: DataFrame) -> dict[str, DataFrame]:
    return {
        CUSTOMERS: left_semi(t[CUSTOMERS], orders, "customer_id", null_safe=True),
        PRODUCTS: left_semi(t[PRODUCTS], items, "product_id", null_safe=True),
        SELLERS: left_semi(t[SELLERS], items, "seller_id", null_safe=True),
    }


def slice_categories(translation: DataFrame, products: DataFrame) -> DataFrame:
    return left_semi(translation, products, "product_category_name", null_safe=True)


def zip_codes(customers: DataFrame, sellers: DataFrame) -> DataFrame:
    """Set union of customer and seller zip prefixes (as text)."""
    return (
        customers.select(F.col("customer_zip_code_prefix").alias("zip"))
        .union(sellers.select(F.col("seller_zip_code_prefix").alias("zip")))
        .distinct()
    )


def slice_geolocation(geolocation: DataFrame, customers: DataFrame, sellers: DataFrame) -> DataFrame:
    return left_semi(geolocation, zip_codes(customers, sellers), "geolocation_zip_code_prefix", "zip",
                     null_safe=True)


def daily_slice(t: Mapping[str, DataFrame], batch_date: date | str) -> dict[str, DataFrame]:
    """The nine landing tables restricted to one purchase date.

    The day's orders, items, customers, products and sellers, by which the other tables
    are restricted, are written once: a day is small next to the tables, and with its size
    known it goes to their scans instead of all their rows through a shuffle."""
    orders = materialize(slice_orders(t[ORDERS], batch_date), "slice-orders")
    items = materialize(slice_children(t[ITEMS], orders), "slice-items")
    parents = {name: materialize(df, "slice-parents") for name, df in slice_parents(t, orders, items).items()}
    return {
        ORDERS: orders,
        ITEMS: items,
        PAYMENTS: slice_children(t[PAYMENTS], orders),
        REVIEWS: slice_children(t[REVIEWS], orders),
        **parents,
        GEO: slice_geolocation(t[GEO], parents[CUSTOMERS], parents[SELLERS]),
        CATEGORIES: slice_categories(t[CATEGORIES], parents[PRODUCTS]),
    }


# --- every day at once -----------------------------------------------------------------

def _key(c: str) -> Column:
    """Text that is never NULL and tells NULL from '': plain equality on it is ``<=>``."""
    return F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit(""))


def _stacked(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def replay_plan(t: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every landing table in the slice of each purchase date.

    A key carries the set of days it is needed on (at most one entry per day
    of the calendar, combined in the map tasks), so a row of any table meets its
    days once, as one row, whatever their number. Tables that share a key
    are stacked and counted in one aggregation: orders, items, payments and reviews
    per order; customers, products and sellers per kind and id; geolocation and
    category names per kind and value.
    """
    o = t[ORDERS].select(purchase_date(t[ORDERS]).alias("day"), _key("order_id").alias("order"), _key("customer_id").alias("customer"))
    items = t[ITEMS].select(_key("order_id").alias("order"), _key("product_id").alias("product"), _key("seller_id").alias("seller"))
    one = F.lit(1).cast("bigint")

    def per_day(df: DataFrame, **columns: Column) -> DataFrame:
        return df.select(F.explode("days").alias("day"), *[c.alias(f"{n}_rows") for n, c in columns.items()])

    # Orders: their days, and the rows of the tables that hang on them.
    children = [t[name].select(_key("order_id").alias("order"), one.alias(name)) for name in (ITEMS, PAYMENTS, REVIEWS)]
    orders = _stacked([o.select("order", "day"), *children]).groupBy("order").agg(
        F.collect_set("day").alias("days"), *[F.sum(n).alias(n) for n in (ITEMS, PAYMENTS, REVIEWS)])
    levels = [o.select("day", one.alias(f"{ORDERS}_rows")), per_day(orders, **{n: F.col(n) for n in (ITEMS, PAYMENTS, REVIEWS)})]

    # What orders refer to: kind, id, and the days it is needed on.
    ids = {CUSTOMERS: ("customer_id", "customer_zip_code_prefix"), PRODUCTS: ("product_id", "product_category_name"),
           SELLERS: ("seller_id", "seller_zip_code_prefix")}
    sold = items.join(orders.select("order", "days"), "order").select(
        F.explode(F.array(F.struct(F.lit(PRODUCTS).alias("kind"), F.col("product").alias("id")),
                          F.struct(F.lit(SELLERS).alias("kind"), F.col("seller").alias("id")))).alias("e"), "days",
    ).select("e.kind", "e.id", F.explode("days").alias("day"))
    needed = _stacked([o.select(F.lit(CUSTOMERS).alias("kind"), F.col("customer").alias("id"), "day"), sold]).groupBy(
        "kind", "id").agg(F.collect_set("day").alias("days"))
    things = _stacked([t[name].select(F.lit(name).alias("kind"), _key(key).alias("id"), _key(value).alias("value"))
                       for name, (key, value) in ids.items()]).groupBy("kind", "id", "value").agg(F.count(F.lit(1)).alias("n"))
    used = things.join(needed, ["kind", "id"])
    levels.append(per_day(used, **{n: F.when(F.col("kind") == n, F.col("n")) for n in ids}))

    # What those refer to: zips and categories.
    values = used.select(F.when(F.col("kind") == PRODUCTS, F.lit(CATEGORIES)).otherwise(F.lit(GEO)).alias("kind"), "value",
                         F.explode("days").alias("day")).groupBy("kind", "value").agg(F.collect_set("day").alias("days"))
    rows = _stacked([t[name].select(F.lit(name).alias("kind"), _key(c).alias("value")) for name, c in (
        (GEO, "geolocation_zip_code_prefix"), (CATEGORIES, "product_category_name"))]).groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n"))
    levels.append(per_day(rows.join(values, ["kind", "value"]), **{n: F.when(F.col("kind") == n, F.col("n")) for n in (GEO, CATEGORIES)}))

    names = (ORDERS, ITEMS, PAYMENTS, REVIEWS, CUSTOMERS, PRODUCTS, SELLERS, GEO, CATEGORIES)
    return _stacked(levels).groupBy(F.col("day").alias("batch_date")).agg(
        *[F.coalesce(F.sum(f"{n}_rows"), F.lit(0)).cast("bigint").alias(f"{n}_rows") for n in names])


def orders_summary(orders: DataFrame, strict: bool = True) -> DataFrame:
    """Order count and first/last purchase date of a landing orders table;
    unless ``strict``, timestamps that do not parse are passed over."""
    d = purchase_date(orders) if strict else F.to_date(F.expr(f"try_to_timestamp(nullif({PURCHASED}, ''))"))
    return orders.agg(
        F.count(F.lit(1)).alias("orders"),
        F.min(d).alias("first_order_date"),
        F.max(d).alias("last_order_date"),
    )


def slice_digest(t: Mapping[str, DataFrame], batch_date: date | str) -> DataFrame:
    """The nine tables of one day's slice as one: (table_name, row_hash, copies),
    a row's content hash with the number of equal rows."""
    return rows_digest(daily_slice(t, batch_date))


def rows_digest(sliced: Mapping[str, DataFrame]) -> DataFrame:
    """The same of a slice at hand."""
    parts = [
        df.select(F.lit(name).alias("table_name"), row_hash(df.columns).alias("row_hash"))
        for name, df in sliced.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("table_name", "row_hash").agg(F.count(F.lit(1)).alias("copies"))
