"""Mergeable exact distinct counts (AG-6): which keys a group holds, as bitmaps that add up.

Every key gets a dense number once, new keys after the known ones, in the order of the group
in which they first occur, so the keys of a group lie in few bitmaps. A state is one
bitmap of 32,768 numbers: (group columns, bucket, bits). States of any groups and batches merge with
``bitmap_or_agg``, and the count of a merged set is exact: a month's customers come from its days'
states, without the orders.

Storage: ``keys/batch-<id>`` and ``states/batch-<id>``, and one commit row per batch, written
last; readers take committed batches only. A batch that died is repeated under its id and
overwrites its own folders; a committed one is left as it is. Single writer assumed.

Defined results: a null key is no key, but its group exists (count 0 without others); null groups
are groups; repeated rows and batches with known keys change nothing; an empty batch adds
no state.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retail_lakehouse.session import materialize
from retail_lakehouse.sources.landing import path_exists

COMMITS = "batch_id string, keys long, committed_at timestamp"
KEYS_PER_TASK = 1_000_000


def commits(spark: SparkSession, root: str) -> dict[str, int]:
    """New keys by committed batch (one driver row per batch)."""
    path = f"{root}/_commits"
    if not path_exists(spark, path):
        return {}
    return {r["batch_id"]: r["keys"] for r in spark.read.schema(COMMITS).parquet(path).collect()}


def _stored(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    parts = [spark.read.parquet(f"{root}/{name}/batch-{b}") for b in commits(spark, root)]
    return reduce(DataFrame.unionByName, parts) if parts else None


def number_keys(new: DataFrame, base: int) -> DataFrame:
    """(key, number) of the distinct keys of ``new`` (key, first): base + 1, base + 2, … by ``first``.

    Numbers are ranks within (first, salt), whose size is bounded by the salt, after the sizes of the
    parts before. The one window over everything has a row per value of ``first``, a group."""
    salts = max(1, -(-new.count() // KEYS_PER_TASK))
    dealt = new.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(salts)))
    sizes = dealt.groupBy("first", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.groupBy("first").agg(F.sum("n").alias("n")).select(
        F.col("first").alias("_first"), F.coalesce(F.sum("n").over(before(Window.orderBy("first"))), F.lit(0)).alias("_below"))
    parts = sizes.select(F.col("first").alias("_f"), F.col("salt").alias("_salt"),
                         F.coalesce(F.sum("n").over(before(Window.partitionBy("first").orderBy("salt"))), F.lit(0)).alias("_beside"))
    ranked = dealt.withColumn("_rank", F.row_number().over(Window.partitionBy("first", "salt").orderBy("key")))
    placed = ranked.join(parts, F.col("first").eqNullSafe(F.col("_f")) & (F.col("salt") == F.col("_salt"))).join(
        firsts, F.col("first").eqNullSafe(F.col("_first")))
    return placed.select("key", (F.lit(base) + F.col("_below") + F.col("_beside") + F.col("_rank")).alias("number"))


def states_of(seen: DataFrame, by: list[str]) -> DataFrame:
    """States of the rows of ``seen`` (``by`` and number)."""
    return seen.groupBy(*by, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def merge_states(states: DataFrame, by: list) -> DataFrame:
    """States of coarser groups."""
    return states.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_states(merged: DataFrame, by: list[str], name: str) -> DataFrame:
    """Exact distinct keys of merged groups."""
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))


def add_batch(rows: DataFrame, root: str, batch_id: str, key: str, by: list[str]) -> int:
    """Add the (``by``, ``key``) pairs of ``rows`` to the states under ``root``; how many keys were new."""
    spark = rows.sparkSession
    done = commits(spark, root)
    if batch_id in done:
        return 0
    seen = materialize(rows.select(*by, F.col(key).alias("key")).distinct(), "distinct-pairs")
    known = _stored(spark, root, "keys")
    new = seen.where(F.col("key").isNotNull()).groupBy("key").agg(F.min(F.struct(*by)).alias("first"))
    if known is not None:
        new = new.join(known.select("key"), "key", "left_anti")
    new = materialize(new, "new-keys")
    fresh = f"{root}/keys/batch-{batch_id}"
    number_keys(new, sum(done.values())).write.mode("overwrite").parquet(fresh)
    added = spark.read.parquet(fresh)
    numbers = added if known is None else known.unionByName(added)
    states_of(seen.join(numbers, "key", "left"), by).write.mode("overwrite").parquet(f"{root}/states/batch-{batch_id}")
    n = added.count()
    spark.createDataFrame([(batch_id, n)], "batch_id string, keys long").withColumn("committed_at", F.current_timestamp()).coalesce(
        1).write.mode("append").parquet(f"{root}/_commits")
    return n


def read_states(spark: SparkSession, root: str, by: list[str]) -> DataFrame:
    """The merged states of all committed batches."""
    states = _stored(spark, root, "states")
    if states is None:
        raise FileNotFoundError(f"no batch of {root} has been committed")
    return merge_states(states, by)


def distinct_by_period(days: DataFrame, day: str, name: str) -> DataFrame:
    """(grain, period, ``name``) for days, months, years and all time from the daily states
    ``days``; each grain is merged from the one below."""
    def coarser(states: DataFrame, unit: str) -> DataFrame:
        return materialize(merge_states(states.withColumn("period", F.trunc("period", unit)), ["period"]), f"states-{unit}")

    daily = materialize(days.withColumnRenamed(day, "period"), "states-day")
    months = coarser(daily, "month")
    years = coarser(months, "year")
    grains = {"day": daily, "month": months, "year": years,
              "all": merge_states(years.withColumn("period", F.lit(None).cast("date")), ["period"])}
    return reduce(DataFrame.unionByName, [count_states(s, ["period"], name).select(F.lit(g).alias("grain"), "period", name)
                                          for g, s in grains.items()])
