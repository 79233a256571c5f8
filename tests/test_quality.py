from retail_lakehouse.operators.quality import accepted_values, non_negative, not_null, relationships, unique


def test_single_checks_return_failing_rows(spark):
    df = spark.createDataFrame([(1, "a", 5, 1.0), (2, "a", 9, -1.0), (None, None, None, 0.0), (3, "b", 5, None)],
                               "id int, k string, score int, amount double")
    parent = spark.createDataFrame([("a",)], "k string")
    assert not_null(df, "id").count() == 1
    assert [(r.k, r.n_records) for r in unique(df, "k").collect()] == [("a", 2)]
    assert sorted(r.k for r in relationships(df, "k", parent, "k").collect()) == ["b"]
    assert [(r.score, r.n_records) for r in accepted_values(df, "score", [1, 2, 3, 4, 5]).collect()] == [(9, 1)]
    assert [r.id for r in non_negative(df, ["amount"]).collect()] == [2]


def test_orphan_keys_counts_rows_of_each_missing_key(spark):
    from retail_lakehouse.operators.quality import orphan_keys
    child = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,), ("b",)], "k string")
    parent = spark.createDataFrame([("a",), ("a",), ("c",)], "k string")
    got = {(r.k, r.n_records) for r in orphan_keys(child, "k", parent, "k").collect()}
    assert got == {("b", 3)}
    # the suite's count equals the row-level definition
    assert relationships(child, "k", parent, "k").count() == 3


def suite_tables(spark):
    child = spark.createDataFrame([(1, "a", 5, 1.0), (2, "a", 9, -1.0), (None, None, None, 0.0), (3, "b", 9, None), (3, "b", 7, -2.0)],
                                  "id int, k string, score int, amount double")
    return {"child": child, "parent": spark.createDataFrame([("a",), ("a",), (None,)], "k string"),
            "empty": spark.createDataFrame([], "id int, k string, score int, amount double")}


def test_stacked_suite_equals_the_single_checks(spark):
    from retail_lakehouse.operators.quality import Check, run_checks
    t = suite_tables(spark)
    suite = [c for name in ("child", "empty") for c in (
        Check("not_null", name, "id"), Check("unique", name, "id"), Check("unique", name, "k"),
        Check("relationships", name, "k", "parent", "k"), Check("relationships", name, "k", "empty", "k"),
        Check("accepted_values", name, "score", values=(1, 5)), Check("non_negative", name, "amount,score"))]
    got = {(r.table_name, r.check_name): (r.failing_rows, r.passed) for r in run_checks(t, suite).collect()}
    want = {}
    for c in suite:
        df = t[c.table]
        failing = {"not_null": lambda: not_null(df, c.column), "unique": lambda: unique(df, c.column),
                   "relationships": lambda: relationships(df, c.column, t[c.to_table], c.to_column) if c.to_table else None,
                   "accepted_values": lambda: accepted_values(df, c.column, c.values),
                   "non_negative": lambda: non_negative(df, c.column.split(","))}[c.kind]().count()
        want[c.table, c.name] = (failing, failing == 0)
    assert got == want and len(got) == len(suite)


def test_the_suite_is_one_shuffle_of_combined_keys(spark):
    import re

    from retail_lakehouse.operators.quality import run_checks
    from retail_lakehouse.plans.quality_suite import SUITE, table_resolver
    from retail_lakehouse.plans.layers import Lakehouse
    lh = Lakehouse.from_driver(spark, "/root/testdata/sf0.001", materialize=("silver", "gold", "mart"))
    lh.bronze = lambda name, bronze=lh.bronze: stored.setdefault(name, materialize(bronze(name)))
    stored = {}
    from retail_lakehouse.session import materialize
    lines = run_checks(table_resolver(lh), SUITE)._jdf.queryExecution().executedPlan().toString().splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len([i for i in exchanges if re.search(r"hashpartitioning\(check#\d+, a#\d+L, b#\d+L", lines[i])]) == 1
    assert len(exchanges) <= 3  # keys, sums per check, and the join with the list of checks
    keyed = next(i for i in exchanges if " a#" in lines[i])
    assert "HashAggregate(keys=[check" in lines[keyed + 1] and "partial_max" in lines[keyed + 1]


def test_rows_that_emit_nothing_are_not_made_distinct(spark):
    from retail_lakehouse.operators.quality import Check, run_checks, stacked_entries
    t = {"t": spark.range(10).selectExpr("cast(id as string) as k", "if(id = 3, null, id) as v", "if(id < 2, -1, null) as w").distinct()}
    suite = [Check("not_null", "t", "v"), Check("non_negative", "t", "w"), Check("accepted_values", "t", "w", values=(5,))]
    lines = stacked_entries(t.__getitem__, suite)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    distinct = next(i for i, line in enumerate(lines) if "Aggregate" in line)
    assert any("Filter" in line for line in lines[distinct:])
    assert [r.failing_rows for r in run_checks(t, suite).orderBy("check_name").collect()] == [1, 2, 1]


def test_keys_of_different_types_are_refused(spark):
    import pytest

    from retail_lakehouse.operators.quality import Check, run_checks
    t = suite_tables(spark)
    with pytest.raises(TypeError):
        run_checks(t, [Check("relationships", "child", "id", "parent", "k")])
