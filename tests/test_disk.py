"""What queries keep on the disks: shuffles, scratch tables, landing files and layers go when nothing reads them any more."""

import os
import time

import pytest
from pyspark.sql import functions as F

from retail_lakehouse import registry
from retail_lakehouse.operators.quality import run_checks
from retail_lakehouse.plans import ingest as I
from retail_lakehouse.plans.layers import Lakehouse
from retail_lakehouse.plans.quality_suite import SUITE, run_apart, table_resolver
from retail_lakehouse.session import ensure_checkpoint_dir, materialize, materialized, shuffles_dropped
from retail_lakehouse.sources import driver_tables as D

from fixtures import DAY, NEXT_DAY
from test_ingest import _landing


@pytest.fixture()
def sf(spark, scratch):
    """Small driver tables, with a null order state, an unknown product and a line that comes twice."""
    rows = {
        "region": "0 r_regionkey, 'east' r_name",
        "nation": "cast(id as int) n_nationkey, concat('n', id) n_name, 0 n_regionkey",
        "customer": "id c_custkey, concat('c', id) c_name, cast(id % 2 as int) c_nationkey, 1.5D * id c_acctbal, 'm' c_mktsegment",
        "supplier": "id s_suppkey, concat('s', id) s_name, cast(id % 2 as int) s_nationkey, 2.5D * id s_acctbal",
        "part": "id p_partkey, concat('p', id) p_name, 'b' p_brand, 'PROMO' p_type, cast(id as int) p_size, 3D p_retailprice",
        "orders": "id o_orderkey, id % 4 o_custkey, if(id = 3, null, 'F') o_orderstatus, 1D o_totalprice, "
                  "timestamp_ntz'2020-01-01 10:00:00' + make_interval(0, 0, 0, id) o_orderdate, 'x' o_orderpriority",
        "lineitem": "id div 2 l_orderkey, if(id = 5, 99, id % 4) l_partkey, id % 3 l_suppkey, cast(id % 2 as int) l_linenumber, 1D l_quantity, "
                    "10D + id l_extendedprice, 0D l_discount, 0.1D l_tax, 'A' l_returnflag, 'O' l_linestatus, "
                    "timestamp_ntz'2020-02-01 10:00:00' + make_interval(0, 0, 0, id) l_shipdate",
        "events": "id event_id, timestamp_ntz'2020-03-01 10:00:00' ts, id user_id, 'click' event_type, 1D value, '{}' props",
    }
    counts = {"region": 1, "nation": 2, "customer": 6, "supplier": 3, "part": 4, "orders": 40, "lineitem": 80, "events": 60}
    for t, n in counts.items():
        df = spark.range(n).selectExpr(*_split(rows[t]))
        if t == "lineitem":
            df = df.unionByName(df.where("l_orderkey = 7"))
        schema = spark.createDataFrame([], D.DRIVER_SCHEMAS[t]).schema
        df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]).write.parquet(f"{scratch}/sf/{t}.parquet")
    return f"{scratch}/sf"


def _split(columns: str) -> list[str]:
    out, depth, start = [], 0, 0
    for i, c in enumerate(columns):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(columns[start:i])
            start = i + 1
    return [*out, columns[start:]]


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def gone(spark, before: set[str]) -> bool:
    """Whether no shuffle files but those of before are left; they are deleted in the background."""
    for _ in range(50):
        if not shuffle_files(spark) - before:
            return True
        time.sleep(0.1)
    return False


def folders(spark) -> set[str]:
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {f"{root}/{n}" for n in os.listdir(root)}


def test_shuffles_go_with_their_job_inside_the_block_only(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, before = spark.conf.get(setting), shuffle_files(spark)
    with shuffles_dropped(spark):
        with shuffles_dropped(spark):
            pass
        out = materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
        assert gone(spark, before)
    assert spark.conf.get(setting) == was and out.count() == 7


@pytest.mark.parametrize("query", ["scan_bronze", "streamed_bronze", "incremental_build"])
def test_landing_files_and_shuffles_go_when_they_are_loaded(spark, sf, query):
    shuffles, before, tables = shuffle_files(spark), folders(spark), set(materialized())
    out = registry.queries()[query](spark, sf)
    new = {f for f in folders(spark) - before if not f.endswith("materialized")}
    assert not [f for f in new if "/stream-state-" in f]
    assert not [f for f in new if "/landing-" in f and os.listdir(f)]
    held = {os.path.basename(t).split("-")[0] for t in set(materialized()) - tables}
    assert held <= {"files", "fresh"}  # a row for each file
    left = {n.split("_")[1] for n in shuffle_files(spark) - shuffles}
    assert gone(spark, shuffles) or len(left) <= 3  # of ledger rows
    assert out.count() > 0


def test_rows_that_meet_the_table_in_one_shuffle_are_those_of_the_two_joins(spark, scratch, monkeypatch):
    landing, found, stored = _landing(spark, scratch), [], []
    stage = I.insert_new_rows
    monkeypatch.setattr(I, "insert_new_rows", lambda target, source, *a: (stored.append(I.STORED in source.columns), stage(target, source, *a))[1])
    for alike in (0, 1000):
        monkeypatch.setattr(I, "ALIKE", alike)
        bronze = os.path.join(scratch, f"bronze-{alike}")
        counts = [I.ingest_batch(spark, landing, bronze, day) for day in (DAY, NEXT_DAY)]
        rows = {n: sorted(map(str, df.select("_row_hash", "_batch_date").collect())) for n, df in I.bronze_tables(spark, bronze).items()}
        ledger = sorted(map(str, I.file_ledger(spark, bronze).select("table_name", "row_count", "inserted_row_count").collect()))
        found.append((counts, rows, ledger))
    assert found[0] == found[1] and True in stored


def test_stored_rows_of_another_layout_or_with_nulls_are_matched_by_hash(spark):
    ds = next(d for d in I.DATASETS if d.table_name == "olist_sellers")
    values = [("1", "10", "a", ""), ("2", "20", "b", "c")]
    landed = spark.createDataFrame(values, list(ds.columns))
    nulls = spark.createDataFrame([("1", "10", "a", None), values[1]], ds.schema)
    files = spark.createDataFrame([(1, "f", None)], "_place long, _source_file string, _batch_date date")
    for layout, table, new in (("struct", nulls, ["1"]), ("array", nulls, []), ("array", landed, []), ("struct", landed, [])):
        target = table.select("*", I.row_hash(ds.columns, layout).alias("_row_hash"))
        source = I.bronze_rows(landed.withColumn("_place", F.lit(1).cast("long")), ds, "b", layout, files, target)
        plain = I.bronze_rows(landed.withColumn("_place", F.lit(1).cast("long")), ds, "b", layout, files)
        assert [r.seller_id for r in I.insert_new_rows(target, source).collect()] == new
        assert [r.seller_id for r in I.insert_new_rows(target, plain).collect()] == new
        other = table.select("*", I.row_hash(ds.columns, "array" if layout == "struct" else "struct").alias("_row_hash"))
        again = I.bronze_rows(landed.withColumn("_place", F.lit(1).cast("long")), ds, "b", layout, files, other)
        assert I.insert_new_rows(other, again).count() == I.insert_new_rows(other, plain).count()


def test_the_suite_in_parts_is_the_suite_and_drops_the_layers(spark, sf):
    whole = run_checks(table_resolver(Lakehouse.from_driver(spark, sf)), SUITE)
    shuffles, tables = shuffle_files(spark), set(materialized())
    out = registry.queries()["data_quality_suite"](spark, sf)
    left = [os.path.basename(t) for t in set(materialized()) - tables]
    assert {n.split("-")[0] for n in left} <= {"checks", "rfm"}
    assert gone(spark, shuffles)
    assert sorted(map(str, out.collect())) == sorted(map(str, whole.collect()))
    parts, paths = run_apart(table_resolver(Lakehouse.from_driver(spark, sf)), SUITE)
    assert len(paths) > 5 and parts.columns == whole.columns and parts.where("NOT passed").count() == whole.where("NOT passed").count() > 0


def test_layers_of_a_large_input_are_built_in_turn_and_the_same(spark, sf, scratch):
    from retail_lakehouse.plans.build import build_all

    shuffles, turns = shuffle_files(spark), []
    lh = Lakehouse.from_driver(spark, sf)
    lh.run_tier("silver", ("orders", "sellers", "order_items"), turns.append, max_workers=1)
    lh.large = True
    lh.run_tier("silver", ("orders", "sellers", "order_items"), turns.append, max_workers=1)
    assert turns == ["orders", "sellers", "order_items", "orders", "order_items", "sellers"]
    rows = build_all(spark, lh, os.path.join(scratch, "lake"))["rows"]
    assert gone(spark, shuffles)
    assert list(rows)[:2] == ["silver.orders", "silver.order_items"] and rows["silver.orders"] == 40 and rows["silver.order_items"] == 80


def test_the_report_check_keeps_no_shuffles_of_what_it_stores(spark, sf):
    shuffles = shuffle_files(spark)
    out = registry.queries()["check_reports"](spark, sf)
    assert gone(spark, shuffles)
    assert out.count() == 6
