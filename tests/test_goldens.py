"""Hand-computed results for the edge cases of the semantics ledger."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retail_lakehouse.functions.columns import row_hash
from retail_lakehouse.operators.quality import Check, run_checks
from retail_lakehouse.plans.layers import Lakehouse
from retail_lakehouse.schemas import BY_TABLE, DATASETS

DAY1 = dt.date(2017, 1, 5)


def _bronze(spark, table, rows, batch_date=DAY1, ingested="2017-01-05 01:00:00"):
    cols = BY_TABLE[table].columns
    data = [tuple(r.get(c, "") for c in cols) for r in rows]
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols)) if data else \
        spark.createDataFrame([], ", ".join(f"{c} string" for c in cols))
    return df.select(
        *cols, row_hash(cols).alias("_row_hash"), F.lit("f.csv").alias("_source_file"),
        F.lit(batch_date).alias("_batch_date"), F.lit(ingested).cast("timestamp").alias("_ingested_at"),
    )


def _order(i, status="delivered", purchase="2017-01-05 10:00:00", delivered="", estimate="2017-01-20 00:00:00",
           customer=None):
    return {"order_id": i, "customer_id": customer or f"c-{i}", "order_status": status,
            "order_purchase_timestamp": purchase, "order_delivered_customer_date": delivered,
            "order_estimated_delivery_date": estimate}


@pytest.fixture(scope="module")
def lh(spark):
    orders = [
        _order("o1", delivered="2017-01-21 00:00:02", estimate="2017-01-20 23:59:59"),  # late by 3 s
        _order("o2", status="canceled"),                                               # no children
        _order("o3", delivered="2017-01-10 12:00:00"),
        _order("o3", status="shipped"),                                                # duplicate id
    ]
    items = [
        {"order_id": "o1", "order_item_id": "1", "product_id": "p1", "seller_id": "s1", "price": "10.00",
         "freight_value": "1.00"},
        {"order_id": "o1", "order_item_id": "2", "product_id": "p2", "seller_id": "s1", "price": "5.00"},
        {"order_id": "o3", "order_item_id": None, "product_id": "p3", "seller_id": "s2", "price": "1.005",
         "freight_value": "0.10"},
    ]
    payments = [{"order_id": "o1", "payment_sequential": "1", "payment_value": "16.00"}]
    reviews = [
        {"review_id": "r1", "order_id": "o1", "review_score": "2", "review_answer_timestamp": "2017-01-22 00:00:00"},
        {"review_id": "r1", "order_id": "o1", "review_score": "5", "review_answer_timestamp": ""},
        {"review_id": "r2", "order_id": "o1", "review_score": "4"},
        {"review_id": "r3", "order_id": "o3", "review_score": "7"},
    ]
    customers = [{"customer_id": f"c-{i}", "customer_unique_id": f"u-{i}", "customer_zip_code_prefix": "1"}
                 for i in ("o1", "o2", "o3")]
    products = [{"product_id": "p1", "product_category_name": "livros"},
                {"product_id": "p2", "product_category_name": "brinquedos"},
                {"product_id": "p3", "product_category_name": ""}]
    sellers = [{"seller_id": "s1", "seller_zip_code_prefix": "2"}, {"seller_id": "s2"},
               {"seller_id": "s9", "seller_zip_code_prefix": "9"}]
    geo = [{"geolocation_zip_code_prefix": "1", "geolocation_lat": "1.00000001", "geolocation_city": "a"},
           {"geolocation_zip_code_prefix": "1", "geolocation_lat": "1.00000002", "geolocation_city": "b"}]
    trans = [{"product_category_name": "livros", "product_category_name_english": "books"},
             {"product_category_name": "livros", "product_category_name_english": "books_b"}]
    src = {"olist_orders": orders, "olist_order_items": items, "olist_order_payments": payments,
           "olist_order_reviews": reviews, "olist_customers": customers, "olist_products": products,
           "olist_sellers": sellers, "olist_geolocation": geo, "product_category_name_translation": trans}
    tables = {d.table_name: _bronze(spark, d.table_name, src[d.table_name]) for d in DATASETS}
    return Lakehouse.from_bronze(spark, tables)


def test_latest_review_version_prefers_answered(lh):
    r = {x.review_id: x.review_score for x in lh.silver("order_reviews").collect()}
    assert r == {"r1": 2, "r2": 4, "r3": 7}


def test_blank_key_part_hashes_the_other_part(lh):
    # A blank CSV field is read as NULL and concat_ws skips it.
    import hashlib
    sk = {x.order_id: x.order_item_sk for x in lh.silver("order_items").collect() if x.order_id == "o3"}
    assert sk["o3"] == hashlib.sha256(b"o3").hexdigest()


def test_fact_rollups(lh):
    fo = {}
    for r in lh.gold("fct_orders").collect():
        fo.setdefault(r.order_id, []).append(r)
    o1 = fo["o1"][0]
    assert (o1.item_count, o1.distinct_product_count, o1.distinct_seller_count) == (2, 2, 1)
    assert o1.item_subtotal == Decimal("15.00") and o1.freight_total == Decimal("1.00")
    assert o1.order_line_total == Decimal("11.00")  # the line without freight is skipped
    assert o1.review_count == 2 and o1.average_review_score == Decimal("3.00")
    o2 = fo["o2"][0]
    assert (o2.item_count, o2.payment_total, o2.review_count, o2.average_review_score) == (0, Decimal("0.00"), 0, None)
    assert len(fo["o3"]) == 2  # duplicate order id is kept, the unique check reports it


def test_products_category_fallbacks(lh):
    p = {r.product_id: r.product_category_name_english for r in lh.gold("dim_products").collect()}
    assert p == {"p1": "books", "p2": "brinquedos", "p3": "unknown"}


def test_geolocation_exact_average(lh):
    g = lh.silver("geolocation").first()
    assert g.latitude == Decimal("1.000000015000") and g.city == "b"


def test_delivery_mart(lh):
    d = lh.mart("mart_delivery_performance").first()
    assert d.order_count == 4 and d.delivered_order_count == 2 and d.late_delivery_count == 1
    assert d.late_delivery_rate == Decimal("0.5000")
    # o1: 16 days; o3 (delivered copy): 5 days -> 10.50
    assert d.average_delivery_days == Decimal("10.50")


def test_quality_checks_catch_edge_rows(lh):
    suite = [Check("unique", "silver_orders", "order_id"),
             Check("accepted_values", "silver_order_reviews", "review_score", values=(1, 2, 3, 4, 5)),
             Check("relationships", "silver_order_items", "seller_id", "silver_sellers", "seller_id"),
             Check("not_null", "silver_order_items", "order_item_id"),
             Check("non_negative", "silver_order_items", "item_price,freight_value")]
    get = lambda n: lh.silver(n.removeprefix("silver_"))
    res = {r.check_name: (r.failing_rows, r.passed) for r in run_checks(get, suite).collect()}
    assert res["unique_silver_orders_order_id"] == (1, False)
    assert res["accepted_values_silver_order_reviews_review_score"] == (1, False)
    assert res["relationships_silver_order_items_seller_id__silver_sellers_seller_id"] == (0, True)
    assert res["not_null_silver_order_items_order_item_id"] == (1, False)
    assert res["non_negative_silver_order_items_item_price_freight_value"] == (0, True)


def test_rfm_when_fewer_customers_than_buckets(lh):
    rfm = {r.customer_unique_id: r for r in lh.mart("mart_customer_rfm").collect()}
    assert set(rfm) == {"u-o1", "u-o2", "u-o3"}
    # three people, five buckets: ntile gives 1, 2, 3 in order
    assert sorted(r.frequency_score for r in rfm.values()) == [1, 2, 3]
    assert all(r.snapshot_date == dt.date(2017, 1, 6) for r in rfm.values())
    assert all(r.rfm_score == f"{r.recency_score}{r.frequency_score}{r.monetary_score}" for r in rfm.values())
