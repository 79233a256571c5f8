import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from retail_lakehouse.plans import distinct_states as S

SCHEMA = "day date, customer string, more int"


def rows(seed, n=600, people=90):
    r = random.Random(seed)
    days = [None, *[date(2019, 11, 20) + timedelta(d) for d in range(0, 90, 3)]]
    return [(r.choice(days), r.choice([None, *[f"c{i}" for i in range(people)]]), i) for i in range(n)]


def counts(df):
    out = {}
    for grain, period in (("day", F.col("day")), ("month", F.trunc("day", "month")), ("year", F.trunc("day", "year")),
                          ("all", F.lit(None).cast("date"))):
        for p, n in df.groupBy(period.alias("p")).agg(F.count_distinct("customer")).collect():
            out[grain, p] = n
    return out


def found(spark, root):
    got = S.distinct_by_period(S.read_states(spark, root, ["day"]), "day", "customers").collect()
    out = {(r["grain"], r["period"]): r["customers"] for r in got}
    assert len(out) == len(got)
    return out


@pytest.mark.parametrize("keys_per_task", [1_000_000, 7])
def test_states_of_batches_add_up(spark, scratch, monkeypatch, keys_per_task):
    monkeypatch.setattr(S, "KEYS_PER_TASK", keys_per_task)
    batches = [rows(1), rows(2, people=200), [], rows(1)[:50], [(date(2022, 5, 1), None, 0)]]
    landed, new = [], []
    for i, some in enumerate(batches):
        landed += some
        new.append(S.add_batch(spark.createDataFrame(some, SCHEMA), scratch, f"b{i}", "customer", ["day"]))
        assert found(spark, scratch) == counts(spark.createDataFrame(landed, SCHEMA))
    people = {c for _, c, _ in landed if c is not None}
    assert sum(new) == len(people) and new[2:] == [0, 0, 0]
    numbers = {r["key"]: r["number"] for r in S._stored(spark, scratch, "keys").collect()}
    assert set(numbers) == people and sorted(numbers.values()) == list(range(1, len(people) + 1))
    assert found(spark, scratch)["day", date(2022, 5, 1)] == 0


def test_numbers_follow_the_first_group(spark, scratch):
    some = [(date(2020, 1, 1 + i % 28), f"k{i * 7919 % 1000}", 0) for i in range(1000)]
    S.add_batch(spark.createDataFrame(some, SCHEMA), scratch, "a", "customer", ["day"])
    numbers = {r["key"]: r["number"] for r in S._stored(spark, scratch, "keys").collect()}
    ordered = [d for _, d in sorted((numbers[k], d) for d, k, _ in some)]
    assert ordered == sorted(ordered)


def test_more_keys_than_one_bitmap(spark, scratch):
    df = spark.range(100_000).selectExpr("date_add(date'2020-01-01', cast(id % 5 as int)) as day", "cast(id % 70000 as string) as customer")
    S.add_batch(df, scratch, "a", "customer", ["day"])
    assert found(spark, scratch) == counts(df)
    assert S.read_states(spark, scratch, ["day"]).select("bucket").distinct().count() == 3


def test_a_batch_that_dies_is_repeated(spark, scratch, monkeypatch):
    first, second = spark.createDataFrame(rows(3), SCHEMA), spark.createDataFrame(rows(4, people=150), SCHEMA)
    S.add_batch(first, scratch, "a", "customer", ["day"])
    before = found(spark, scratch)

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(S, "states_of", die)
        with pytest.raises(RuntimeError):
            S.add_batch(second, scratch, "b", "customer", ["day"])
    assert found(spark, scratch) == before  # its keys lie there, uncommitted
    assert S.add_batch(second, scratch, "b", "customer", ["day"]) > 0
    assert S.add_batch(first, scratch, "b", "customer", ["day"]) == 0  # committed: left as it is
    assert found(spark, scratch) == counts(first.unionByName(second))


def test_nothing_committed(spark, scratch):
    with pytest.raises(FileNotFoundError):
        S.read_states(spark, scratch, ["day"])
