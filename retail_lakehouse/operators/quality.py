"""Data-quality operators (DQ-1 … DQ-7).

Each check returns its *failing* rows (what a schema test query returns);
``run_checks`` turns a suite into one DataFrame of
``(check_name, table_name, column_name, failing_rows, passed)``.

Scale: a suite is one aggregation. Every table is scanned once and emits, for all of
its checks together, rows (check, key, side), which are combined in the map tasks and
cross one shuffle. No rows reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# --- single checks: failing rows ------------------------------------------------

def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """Non-NULL values that occur more than once, with their counts."""
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(col).agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    p = parent.select(F.col(parent_col).alias("_parent_key"))
    return child.where(F.col(col).isNotNull()).join(p, F.col(col) == p["_parent_key"], "left_anti")


def orphan_keys(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Orphan child keys with their row counts: ``relationships`` grouped by
    key. The child is counted per key *before* it meets the parent (partial
    aggregate in every map task), so a key holding a third of the child rows
    crosses the shuffle as one row per map task; the parent side is its
    distinct keys. Written as a left outer join plus ``IS NULL`` rather than
    an anti join, because Catalyst pushes an anti join below the aggregate,
    which would shuffle raw child rows whenever the parent is too big to
    broadcast."""
    per_key = (
        child.where(F.col(col).isNotNull())
        .groupBy(F.col(col).alias("_child_key")).agg(F.count(F.lit(1)).alias("n_records"))
    )
    p = parent.select(F.col(parent_col).alias("_parent_key")).distinct()
    return (
        per_key.join(p, per_key["_child_key"] == p["_parent_key"], "left")
        .where(F.col("_parent_key").isNull())
        .select(F.col("_child_key").alias(col), "n_records")
    )


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Distinct non-NULL values outside ``values``, with their counts."""
    return (
        df.where(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))
        .groupBy(col).agg(F.count(F.lit(1)).alias("n_records"))
    )


def non_negative(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    cond = None
    for c in cols:
        cond = (F.col(c) < 0) if cond is None else (cond | (F.col(c) < 0))
    return df.where(cond)


# --- suites ------------------------------------------------------------------------

@dataclass(frozen=True)
class Check:
    kind: str  # not_null | unique | relationships | accepted_values | non_negative
    table: str
    column: str
    to_table: str | None = None
    to_column: str | None = None
    values: tuple = field(default=())

    @property
    def name(self) -> str:
        if self.kind == "relationships":
            return f"relationships_{self.table}_{self.column}__{self.to_table}_{self.to_column}"
        return f"{self.kind}_{self.table}_{self.column.replace(',', '_')}"


# What an entry says about its key.
FAILS, CHILD, PARENT = 0, 1, 2


def stacked_entries(tables: Callable[[str], DataFrame], suite: Sequence[Check]) -> DataFrame:
    """All that the checks need, as rows (check, a, b, side): the check's
    number, 128 bits of a key, and what the row is. One scan per table feeds all of
    its checks, as child and as parent; passing values of row checks emit nothing."""
    wanted: dict[str, list[tuple[Column, Column]]] = {}

    def entry(i: int, condition: Column, key: Column | None, side: int) -> tuple[Column, Column]:
        bits = [F.lit(0).cast("long")] * 2 if key is None else [F.xxhash64(key), F.xxhash64(key, F.lit("b"))]
        return condition, F.when(condition, F.struct(F.lit(i).alias("check"), bits[0].alias("a"), bits[1].alias("b"),
                                                     F.lit(side).cast("byte").alias("side")))

    for i, c in enumerate(suite):
        mine = wanted.setdefault(c.table, [])
        col = F.col(c.column.split(",")[0])
        if c.kind == "not_null":
            mine.append(entry(i, col.isNull(), None, FAILS))
        elif c.kind == "non_negative":
            below = [F.coalesce(F.col(name) < 0, F.lit(False)) for name in c.column.split(",")]
            mine.append(entry(i, F.array_contains(F.array(*below), True), None, FAILS))
        elif c.kind == "accepted_values":
            mine.append(entry(i, ~col.isin(list(c.values)), col, FAILS))
        elif c.kind == "unique":
            mine.append(entry(i, col.isNotNull(), col, CHILD))
        elif c.kind == "relationships":
            mine.append(entry(i, col.isNotNull(), col, CHILD))
            parent = F.col(c.to_column)
            wanted.setdefault(c.to_table, []).append(entry(i, parent.isNotNull(), parent, PARENT))
        else:
            raise ValueError(f"unknown check kind {c.kind!r}")
    # Rows that emit nothing are left out first: where a table is made distinct only now, they need not be.
    parts = [tables(name).where(reduce(Column.__or__, [condition for condition, _ in entries]))
             .select(F.explode(F.array_compact(F.array(*[e for _, e in entries]))).alias("e")).select("e.*")
             for name, entries in wanted.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_checks(tables: Mapping[str, DataFrame] | Callable[[str], DataFrame],
               suite: Sequence[Check]) -> DataFrame:
    """Evaluate a suite; one output row per check.

    The entries of all checks are counted per (check, key) in the map tasks,
    cross one shuffle, and are judged per key: more than one child of a unique
    key fails the key, children without a parent fail one by one. So a key that holds a third
    of a table is one row per map task, and the number of shuffles does not grow with the suite.
    Keys are told apart by 128 bits of hash; columns compared must have one type."""
    get = tables if callable(tables) else tables.__getitem__
    _same_types(get, suite)
    spark = get(suite[0].table).sparkSession
    per_key = stacked_entries(get, suite).groupBy("check", "a", "b").agg(
        F.count_if(F.col("side") != PARENT).alias("n"), F.max(F.col("side") == PARENT).alias("parent"))
    kinds = [(i, c.kind, c.name, c.table, c.column) for i, c in enumerate(suite)]
    number = {kind: [i for i, k, *_ in kinds if k == kind] for _, kind, *_ in kinds}

    def of(kind: str) -> Column:
        return F.col("check").isin(number.get(kind, []))

    failing = (
        F.when(of("unique"), (F.col("n") > 1).cast("long"))
        .when(of("relationships"), F.when(~F.col("parent"), F.col("n")).otherwise(0))
        .when(of("accepted_values"), F.lit(1).cast("long"))
        .otherwise(F.col("n"))
    )
    counts = per_key.groupBy("check").agg(F.sum(failing).alias("failing"))
    names = spark.createDataFrame(kinds, "number int, kind string, check_name string, table_name string, column_name string")
    return names.join(counts, F.col("number") == F.col("check"), "left").select(
        "check_name", "table_name", "column_name", F.coalesce("failing", F.lit(0)).cast("bigint").alias("failing_rows"),
    ).withColumn("passed", F.col("failing_rows") == 0)


def _same_types(get: Callable[[str], DataFrame], suite: Sequence[Check]) -> None:
    for c in suite:
        if c.kind == "relationships":
            child, parent = get(c.table).schema[c.column].dataType, get(c.to_table).schema[c.to_column].dataType
            if child != parent:
                raise TypeError(f"{c.name}: {child.simpleString()} against {parent.simpleString()}")
