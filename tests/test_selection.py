import os
import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from retail_lakehouse import registry
from retail_lakehouse.operators import selection
from retail_lakehouse.operators.selection import bucket_before, bucket_by_starts, order_key, quantile_starts
from retail_lakehouse.session import drop_materialized, materialize, materialized

SCHEMA = "id string, whole long, day date, money decimal(16,2)"


def people(n, distinct, seed, ident=lambda i: f"k{i:05d}"):
    r = random.Random(seed)
    some = [None, *range(distinct)]
    rows = []
    for i in range(n):
        a, b, c = r.choice(some), r.choice(some), r.choice(some)
        rows.append((ident(i), a, None if b is None else date(2020, 1, 1) + timedelta(b),
                     None if c is None else Decimal(c - distinct // 2) / 100))
    return rows


def check(spark, rows, n, k=selection.SKETCH_K):
    df = materialize(spark.createDataFrame(rows, SCHEMA))
    down = F.col("day").desc_nulls_first()
    windows = {"whole": F.col("whole").asc_nulls_first(), "day": F.col("day").asc_nulls_first(),
               "down": down, "money": F.col("money").asc_nulls_first()}
    keys = {"whole": order_key(df, "whole"), "day": order_key(df, "day"),
            "down": order_key(df, "day", descending=True), "money": order_key(df, "money")}
    starts = quantile_starts(df, n, keys, "id", k)
    got = df.select("id", *[bucket_by_starts(starts[c], keys[c], "id").alias(c) for c in keys])
    want = df.select("id", *[F.ntile(n).over(Window.orderBy(o, F.col("id").asc_nulls_first())).alias(c) for c, o in windows.items()])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


@pytest.mark.parametrize("n_rows,n,distinct", [(0, 5, 1), (1, 5, 1), (3, 5, 2), (100, 5, 4), (1003, 7, 40), (57, 5, 57)])
def test_equals_window_ntile(spark, n_rows, n, distinct):
    check(spark, people(n_rows, distinct, n_rows), n)


@pytest.mark.parametrize("ident", [
    lambda i: f"one-common-beginning-{i}", lambda i: str(i), lambda i: None if i == 7 else "é" * (i % 40) + str(i), lambda i: "x" * i])
def test_one_key_for_nearly_all_rows_and_any_tie_break(spark, ident):
    """A coarse sketch (errors of many ranks) and long runs of equal keys."""
    check(spark, people(3000, 1, 3, ident), 5, k=8)


def test_cuts_outside_their_brackets_are_sought_again(spark, monkeypatch):
    monkeypatch.setattr(selection, "sketch_error", lambda k: -0.2)  # brackets beside the cuts, and empty
    check(spark, people(500, 30, 4), 5)


def test_bucket_before():
    for rows in range(12):
        sizes = [sum(1 for i in range(rows) if next(b for b, (lo, hi) in enumerate(bounds(rows, 5)) if lo <= i < hi) == b0) for b0 in range(5)]
        starts = [sum(sizes[:b]) for b in range(1, 5) if sizes[b]]
        assert bucket_before(rows, 5) == starts


def bounds(rows, n):
    size, larger = divmod(rows, n)
    at, out = 0, []
    for j in range(n):
        out.append((at, at + size + (j < larger)))
        at = out[-1][1]
    return out


def test_long_decimals_are_refused(spark):
    with pytest.raises(TypeError):
        order_key(spark.createDataFrame([], "a decimal(20,2)"), "a")


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_rfm_ranks_no_person_row_and_writes_one_table(spark):
    before = set(materialized())
    mart = registry.queries()["mart_customer_rfm"](spark, SF)
    text = mart._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "Exchange rangepartitioning" not in text
    new = [t for t in materialized() if t not in before]
    assert len(new) == 1 and "rfm-metrics" in new[0]
    drop_materialized(spark, new)
