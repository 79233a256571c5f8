"""Distributed ``ntile``.

``ntile(n) over (order by k)`` has no partition key, so Spark plans it through
a single task. Here the rows are range-partitioned on the full (unique) sort
order, each task numbers its rows locally, and a per-partition count table
(one row per partition, so its size is bounded by the partition count) gives
the offsets. The numbered frame is written to the shared checkpoint folder
first: range boundaries come from a sample, so the counting pass and the
numbering pass must read the same frame.

With ``N`` rows, ``b = N div n`` and ``r = N mod n``, the first ``r`` buckets
hold ``b + 1`` rows and the rest ``b`` — the SQL definition of ``ntile``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_lakehouse.session import input_bytes, materialize

# Range partitions of the numbered frame: one per this many stored input bytes
# (columnar and compressed, so a task sorts a few times as much).
FRAME_BYTES_PER_PARTITION = 64 * 1024 * 1024

_LOCAL_BITS = 33  # monotonically_increasing_id = partition id << 33 | row index


def _sort_cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]


def frame_partitions(df: DataFrame, columns: int) -> int:
    """Range partitions for ``columns`` columns of ``df``: from the size of the
    files it reads (a table written before), at least the parallelism."""
    spark, files = df.sparkSession, df.inputFiles()
    folders = {f.rsplit("/", 1)[0] for f in files}
    share = min(1.0, columns / max(1, len(df.columns)))
    wanted = -(-int(input_bytes(spark, folders) * share) // FRAME_BYTES_PER_PARTITION)
    return max(spark.sparkContext.defaultParallelism, wanted)


def row_positions(df: DataFrame, order: Sequence[Column | str], partitions: int | None = None,
                  position_col: str = "_pos", total_col: str = "_total") -> DataFrame:
    """Add the 1-based global position of every row under ``order`` (which
    must be a total order) and the row total, without a single-task window."""
    sort = _sort_cols(order)
    n_parts = partitions or frame_partitions(df, len(df.columns))
    # The row id encodes (range partition, position inside it); writing it
    # fixes the frame, so the counting pass and the numbering pass agree.
    framed = materialize(
        df.repartitionByRange(n_parts, *sort)
        .sortWithinPartitions(*sort)
        .withColumn("_rid", F.monotonically_increasing_id()),
        "ntile-frame",
    )
    part = F.shiftright(F.col("_rid"), _LOCAL_BITS)
    local = F.col("_rid") - F.shiftleft(part, _LOCAL_BITS)
    counts = framed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per partition: the prefix sum runs over at most `n_parts` rows.
    running = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy(F.lit(0))
    offsets = counts.select(
        "_part",
        (F.sum("_rows").over(running) - F.col("_rows")).alias("_offset"),
        F.sum("_rows").over(everything).alias(total_col),
    )
    return (
        framed.join(F.broadcast(offsets), part == F.col("_part"))
        .withColumn(position_col, F.col("_offset") + local + F.lit(1))
        .drop("_rid", "_part", "_offset")
    )


def ntile_bucket(position: Column, total: Column, n: int) -> Column:
    """Bucket (1..n) of a 1-based position among ``total`` rows."""
    b = F.call_function("div", total, F.lit(n))
    r = F.pmod(total, F.lit(n))
    big = r * (b + 1)
    first = F.call_function("div", position - 1, b + 1) + 1
    rest = F.call_function("div", position - 1 - big, F.nullif(b, F.lit(0))) + r + 1
    return F.when(position <= big, first).otherwise(rest).cast("int")


def distributed_ntile(df: DataFrame, n: int, order: Sequence[Column | str], out_col: str,
                      reverse: bool = False, partitions: int | None = None) -> DataFrame:
    """``ntile(n) over (order by …)`` (``n + 1 - ntile`` when ``reverse``).
    ``order`` must end in a unique tie-break so the result is repeatable."""
    ranked = row_positions(df, order, partitions)
    bucket = ntile_bucket(F.col("_pos"), F.col("_total"), n)
    if reverse:
        bucket = (F.lit(n + 1) - bucket).cast("int")
    return ranked.withColumn(out_col, bucket).drop("_pos", "_total")
