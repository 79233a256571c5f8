import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from retail_lakehouse.functions.columns import (
    exact_avg,
    exact_quotient,
    iso_day_of_week,
    row_hash,
    surrogate_key,
    try_type,
)


def test_exact_avg_does_not_round_twice(spark):
    # 25,000 payments whose true mean is 1.0049996: Spark's avg rounds to
    # 1.005000 first and then to 1.01; the exact mean rounds to 1.00.
    n = 25_000
    rows = [(Decimal("1.00"),)] * (n - 12_500) + [(Decimal("1.01"),)] * 12_499 + [(Decimal("1.00"),)]
    total = sum(r[0] for r in rows)
    assert abs(total / n - Decimal("1.0049996")) < Decimal("0.0000001")
    df = spark.createDataFrame(rows, "v decimal(14,2)")
    out = df.agg(exact_avg("v", 2, input_scale=2, precision=14).alias("a"),
                 F.avg("v").cast("decimal(14,2)").alias("spark_avg")).first()
    assert out["a"] == Decimal("1.00")
    assert out["spark_avg"] == Decimal("1.01")


def test_exact_quotient_half_away_from_zero(spark):
    df = spark.createDataFrame([(Decimal("-2.01"), 2), (Decimal("2.01"), 2), (Decimal("1.00"), 3),
                                (Decimal("5.00"), 0)], "num decimal(10,2), den int")
    got = [r[0] for r in df.select(exact_quotient("num", "den", 2, 2, 10)).collect()]
    assert got == [Decimal("-1.01"), Decimal("1.01"), Decimal("0.33"), None]


def test_exact_avg_of_integers(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "s int")
    assert df.agg(exact_avg("s", 2, precision=4)).first()[0] == Decimal("1.67")


def test_tolerant_casts(spark):
    df = spark.createDataFrame([("2017", " 7 ", "7.9", "1.005", "abc", "")], "a string, b string, c string, d string, e string, f string")
    r = df.select(
        try_type("a", "timestamp").alias("a"), try_type("b", "int").alias("b"), try_type("c", "int").alias("c"),
        try_type("d", "decimal(12,2)").alias("d"), try_type("e", "timestamp").alias("e"),
        try_type("f", "int").alias("f"),
    ).first()
    assert r["a"] == dt.datetime(2017, 1, 1)
    assert r["b"] == 7
    assert r["c"] is None
    assert r["d"] == Decimal("1.01")
    assert r["e"] is None and r["f"] is None


def test_surrogate_key_skips_null_parts(spark):
    df = spark.createDataFrame([("o1", None), ("o1", "1")], "order_id string, item string")
    keys = [r[0] for r in df.select(surrogate_key(["order_id", "item"])).collect()]
    import hashlib
    assert keys[0] == hashlib.sha256(b"o1").hexdigest()
    assert keys[1] == hashlib.sha256(b"o1||1").hexdigest()
    md5 = df.select(surrogate_key(["order_id", "item"], "md5")).collect()[1][0]
    assert md5 == hashlib.md5(b"o1||1").hexdigest()


def test_row_hash_layouts(spark):
    import hashlib
    import json
    df = spark.createDataFrame([("a", None, 'x"y')], "c1 string, c2 string, c3 string")
    r = df.select(row_hash(["c1", "c2", "c3"]).alias("s"), row_hash(["c1", "c2", "c3"], "array").alias("a")).first()
    assert r["s"] == hashlib.sha256(json.dumps({"c1": "a", "c3": 'x"y'}, separators=(",", ":")).encode()).hexdigest()
    assert r["a"] == hashlib.sha256(json.dumps(["a", "", 'x"y'], separators=(",", ":")).encode()).hexdigest()


def test_iso_day_of_week(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 7),)], "d date")
    assert [r[0] for r in df.select(iso_day_of_week("d")).collect()] == [1, 7]


def test_elapsed_days_of_a_busy_day_pass_the_range_of_a_long(spark):
    from retail_lakehouse.plans.marts import mart_delivery_performance
    # 2000 orders, each ten years under way: 6.3e17 microseconds, 6.3e19 in hundredths.
    orders = spark.range(2000).selectExpr(
        "DATE'2010-01-01' AS order_purchase_date", "TIMESTAMP'2010-01-01 00:00:00' AS order_purchase_at",
        "TIMESTAMP'2020-01-01 12:00:00' AS order_delivered_customer_at", "TIMESTAMP'2019-12-31 12:00:00' AS order_estimated_delivery_at")
    row = mart_delivery_performance(orders, "elapsed").first()
    assert (row["average_delivery_days"], row["average_days_vs_estimate"]) == (Decimal("3652.50"), Decimal("1.00"))
