import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from retail_lakehouse.operators import ntile
from retail_lakehouse.operators.ntile import distributed_ntile, frame_partitions
from retail_lakehouse.session import materialize


@pytest.mark.parametrize("n_rows,n,distinct,parts", [
    (0, 5, 3, 4), (3, 5, 2, 4), (7, 5, 1, 3), (100, 5, 4, 4), (1001, 7, 50, 5), (2500, 5, 2500, 8),
])
def test_distributed_ntile_equals_window_ntile(spark, n_rows, n, distinct, parts):
    rnd = random.Random(n_rows * 31 + n)
    rows = [(f"k{i:05d}", rnd.randrange(distinct)) for i in range(n_rows)]
    df = spark.createDataFrame(rows, "id string, v int")
    order = [F.col("v").asc_nulls_first(), F.col("id").asc_nulls_first()]
    expect = {r["id"]: r["b"] for r in df.select("id", F.ntile(n).over(Window.orderBy(*order)).alias("b")).collect()}
    got = {r["id"]: r["b"] for r in distributed_ntile(df, n, order, "b", partitions=parts).collect()}
    assert got == expect
    rev = {r["id"]: r["b"] for r in distributed_ntile(df, n, order, "b", reverse=True, partitions=parts).collect()}
    assert rev == {k: n + 1 - v for k, v in expect.items()}


def test_frame_partitions_follow_the_stored_bytes(spark, monkeypatch):
    df = materialize(spark.range(1000).selectExpr("id", "id as a", "id as b", "id as c"))
    monkeypatch.setattr(ntile, "input_bytes", lambda spark, folders: 64 * 1024 ** 3)
    assert frame_partitions(df, 4) == 1024 and frame_partitions(df, 2) == 512
