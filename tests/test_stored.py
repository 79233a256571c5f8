"""Stored layers: versions, commits, buckets."""

import os

import pytest
from pyspark.sql import functions as F

from retail_lakehouse import registry
from retail_lakehouse.plans import layers, marts, warehouse
from retail_lakehouse.plans.layers import BY_ORDER, Lakehouse
from retail_lakehouse.sources import stored
from retail_lakehouse.sources.stored import drop_old_versions, latest_commit, layout_of, read_table, write_layer

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_rebuild_may_read_the_table_itself(spark, scratch):
    path = os.path.join(scratch, "t")
    assert write_layer(spark.range(10).toDF("n"), path) == 10
    assert write_layer(read_table(spark, scratch, "t").where("n < 4").withColumn("m", F.col("n") * 2), path) == 4
    assert rows(read_table(spark, scratch, "t")) == [(n, 2 * n) for n in range(4)]
    assert latest_commit(spark, path).sequence == 1


def test_a_build_that_dies_leaves_the_old_table(spark, scratch, monkeypatch):
    path = os.path.join(scratch, "t")
    write_layer(spark.range(5).toDF("n"), path)
    with pytest.raises(Exception):  # in the middle of the write
        write_layer(spark.range(100).select(F.when(F.col("id") > 50, F.raise_error(F.lit("lost"))).otherwise("").alias("n")), path)
    assert rows(read_table(spark, scratch, "t")) == [(n,) for n in range(5)]
    # all files written, but the commit row is not
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        write_layer(spark.range(7).toDF("n"), path)
    monkeypatch.undo()
    assert rows(read_table(spark, scratch, "t")) == [(n,) for n in range(5)]
    assert drop_old_versions(spark, path) == 2  # both unfinished ones
    assert rows(read_table(spark, scratch, "t")) == [(n,) for n in range(5)]


def test_uncommitted_table_is_an_error(spark, scratch):
    with pytest.raises(FileNotFoundError):
        read_table(spark, scratch, "nothing")
    assert drop_old_versions(spark, os.path.join(scratch, "nothing")) == 0


def test_buckets_need_no_exchange_in_this_and_in_another_session(spark, scratch):
    path = os.path.join(scratch, "t")
    df = spark.range(1000).selectExpr("cast(id % 100 as string) as k", "id as v", "cast(id as decimal(12,2)) as d")
    assert write_layer(df, path, bucket_by="k", buckets=4) == 1000
    assert layout_of(spark, path) == ("k", 4)
    for session in (spark, spark.newSession()):
        if session is not spark:  # an empty catalog, as in another application
            spark.sql(f"DROP TABLE stored_{latest_commit(spark, path).version}")
        t = read_table(session, scratch, "t")
        sums = t.groupBy("k").agg(F.sum("v").alias("s"))
        joined = t.join(sums.hint("merge"), "k")
        assert "Exchange" not in plan(sums) and "Exchange" not in plan(joined)
        assert rows(t) == rows(df) and joined.count() == 1000


def test_a_hot_key_is_stored_without_layout(spark, scratch, monkeypatch):
    monkeypatch.setattr(stored, "SMALLEST", 1000)
    hot = spark.range(20_000).selectExpr("if(id % 10 < 8, 'hot', cast(id as string)) as k", "uuid() as v")
    path = os.path.join(scratch, "t")
    assert write_layer(hot, path, bucket_by="k", buckets=16) == 20_000
    assert layout_of(spark, path) is None
    assert read_table(spark, scratch, "t").count() == 20_000
    assert stored.even([10, 10], 2) and not stored.even([10_000, 10, 10, 10, 10, 10], 6) and stored.even([], 4)


def test_old_versions_go(spark, scratch):
    path = os.path.join(scratch, "t")
    for n in range(4):
        write_layer(spark.range(n).toDF("n"), path, bucket_by="n", buckets=2)
    assert drop_old_versions(spark, path, keep=2) == 2 and drop_old_versions(spark, path) == 1
    assert read_table(spark, scratch, "t").count() == 3


def test_partitioned_layers(spark, scratch):
    path = os.path.join(scratch, "t")
    assert write_layer(spark.range(6).selectExpr("id", "id % 2 as p"), path, partition_by=("p",)) == 6
    assert rows(read_table(spark, scratch, "t").where("p = 1").select("id")) == [(1,), (3,), (5,)]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_facts_and_the_seller_mart_from_stored_layers_exchange_nothing_by_order(spark):
    lh = Lakehouse.from_driver(spark, SF, materialize=("silver", "gold"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if every table were large
    try:
        s = {n: lh.silver(n) for n in BY_ORDER["silver"]}
        assert lh.by_order()
        fct = warehouse.fct_orders(s["orders"], s["order_items"], s["order_payments"], s["order_reviews"], by_order=True)
        lines = warehouse.fct_order_items(s["order_items"], s["orders"])
        assert "Exchange" not in plan(fct) and "Exchange" not in plan(lines)
        assert rows(fct) == rows(registry.queries()["fct_orders"](spark, SF))
        assert rows(lines) == rows(registry.queries()["fct_order_items"](spark, SF))
        mart = marts.mart_seller_performance(lh.gold("dim_sellers"), lh.gold("fct_order_items"), lh.gold("fct_orders"))
        text = plan(mart)
        assert "order_id" not in "".join(line for line in text.splitlines() if "Exchange" in line) and text.count("Exchange") == 2
        assert rows(mart) == rows(registry.queries()["mart_seller_performance"](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", ["orders", "order_items", "order_payments"])
def test_rows_are_dealt_by_order_before_they_get_their_hashes(spark, monkeypatch, name):
    def noted(df, path, **kw):
        seen.append((df, kw))
        return write_layer(df, path, **kw)

    seen: list = []
    monkeypatch.setattr(layers, "write_layer", noted)
    lh = Lakehouse.from_driver(spark, SF, materialize=("silver",))
    table = lh.silver(name)
    (df, kw), = seen
    lines = plan(df).splitlines()
    dealt = next(i for i, line in enumerate(lines) if "REPARTITION_BY_NUM" in line)
    assert kw["dealt"] and any("sha2" in line for line in lines[:dealt]) and not any("sha2" in line for line in lines[dealt:])
    assert f"silver.{name}" in lh._dealt and "Exchange" not in plan(table.groupBy("order_id").count())
    assert rows(table) == rows(registry.queries()[f"silver_{name}"](spark, SF))


def test_layers_are_stored_small(spark, scratch):
    for name, kw in (("plain", {}), ("bucketed", {"bucket_by": "k", "buckets": 2})):
        write_layer(spark.range(10).selectExpr("cast(id as string) as k"), os.path.join(scratch, name), **kw)
        files = [f for version in os.listdir(os.path.join(scratch, name)) if version.startswith("version-")
                 for f in os.listdir(os.path.join(scratch, name, version)) if f.startswith("part-")]
        assert files and all(".zstd." in f for f in files)


def test_the_report_check_stores_only_what_is_read_again(spark):
    from retail_lakehouse.session import table_scope
    with table_scope() as stored_here:
        lh = Lakehouse.from_driver(spark, SF, materialize=layers.REPORT_TABLES)
        fct, lines = lh.gold("fct_orders"), lh.gold("fct_order_items")
        lh.mart("mart_seller_performance")
    assert len(stored_here) == 2 and not any("fct_order_items" in path for path in stored_here)
    assert plan(lines).count("orders.parquet") == 0  # the stored fact stands for the orders
    for name, df in (("fct_orders", fct), ("fct_order_items", lines)):
        assert rows(df) == rows(registry.queries()[name](spark, SF))


def test_distinct_counts_taken_apart_are_the_same_and_send_each_line_once(spark):
    items = spark.createDataFrame([("a", "p", "s", 1, 2), ("a", "p", "t", 1, None), ("a", None, "t", 3, 1), (None, "p", "s", 1, 1), ("b", None, None, None, 1)],
                                  "order_id string, product_id string, seller_id string, item_price int, freight_value int")
    apart, plain = warehouse._item_rollup(items, False, apart=True), warehouse._item_rollup(items, False)
    known = F.col("order_id").isNotNull()
    assert rows(apart.where(known).select(*plain.columns)) == rows(plain.where(known)) and "Expand" not in plan(apart)
