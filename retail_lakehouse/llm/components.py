"""Connected components of a large edge table by alternating stars.

Every round joins each edge with the smallest neighbour of its end (a minimum
that is combined in the map tasks, so a vertex with very many edges is one row
per task) and writes the new edges to the shared folder, which cuts the lineage.
The rounds end when the written edges are stars, which one grouping tells; a
round more would only write them again. Edges are two numbers: the tables are
written by as many tasks as their rows ask for, not one per shuffle partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lakehouse.llm.common import buckets_for, materialize

EDGES = 100_000  # of one task that writes edges


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    """(number of edges, vertices that keep ``edges`` (a > b) from being stars
    around their smallest vertices: those with two edges down, or one down and one up)."""
    ends = edges.select(F.col("a").alias("vertex"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    seen = ends.groupBy("vertex").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return tuple(seen.agg(F.coalesce(F.sum("down"), F.lit(0)), F.count_if(F.expr("down > 1 or (down = 1 and up = 1)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root) for every vertex of ``edges`` (a, b: long), a stored table,
    as it is read several times; ``root`` is the smallest vertex of its
    component. Self-loops are ignored."""
    now = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    cores = edges.sparkSession.sparkContext.defaultParallelism
    while True:
        n, unsettled = _state(now)
        if not unsettled:
            break
        tasks = max(cores, buckets_for(n, EDGES))
        now = materialize(_small_star(materialize(_large_star(now).coalesce(tasks), "edges")).coalesce(tasks), "edges")
    # Now every edge goes from a vertex to its root.
    return now.select(F.col("a").alias("vertex"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct())
