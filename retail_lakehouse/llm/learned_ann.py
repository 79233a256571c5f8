"""Nearest neighbours with learned partitions.

Learning, on a bounded sample (``sample`` ids with the smallest hashes, taken from those
under a cut computed from the number of rows; of rows with one id the smallest vector): the
sample's neighbour graph is cut into ``parts`` balanced parts by recursive
bisection (each half ordered along the slowest vector of the graph's random walk
and cut in the middle), and a softmax classifier learns a vector's part. The
number of parts a query probes is the smallest at which ``target_recall`` of the
sample's own true neighbours are found, all parts if none does it.

Index and search: every row is put into its most probable part; a query goes to
its most probable parts and is compared there with all rows, by inner product in
double precision. A part is a grid of (row block, query block) cells of bounded
size, so one that holds a third of all rows, or one vector repeated very often,
is spread over many tasks; of equal vectors a cell scores only the rows with the
smallest ids that a query can need, and returns at most k rows per query.

Defined results: vectors that are null, empty, zero or hold a null or non-finite
component take no part, nor do those whose length is not the most common one;
ties go to the smaller vec_id; equal vec_ids are separate candidates, but a query
never meets rows with its own id; a query takes further parts until they hold k
other rows, so one with fewer candidates gets them all; empty tables give an
empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_lakehouse.llm.common import buckets_for, hash_cut, materialize
from retail_lakehouse.llm.interpolated_lm import _by_key

ROWS_PER_CELL = 20_000
QUERIES_PER_CELL = 4_000
RESCORED = 2_000_000  # components multiplied at a time


@dataclass(frozen=True)
class Fit:
    """Bounds and aims of learning."""

    sample: int = 8192
    parts: int = 16
    graph_neighbours: int = 16
    target_recall: float = 0.95
    rounds: int = 300


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows of each row by inner product."""
    out = np.empty((len(x), min(k, len(x) - 1)), dtype=np.int64)
    for lo in range(0, len(x), 1024):
        s = x[lo:lo + 1024] @ x.T
        s[np.arange(len(s)), np.arange(lo, lo + len(s))] = -np.inf
        top = np.argpartition(-s, out.shape[1] - 1, axis=1)[:, :out.shape[1]]
        out[lo:lo + 1024] = np.take_along_axis(top, np.argsort(-np.take_along_axis(s, top, 1), axis=1, kind="stable"), 1)
    return out


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 5) -> np.ndarray:
    """A balanced partition of the graph's nodes that cuts few edges."""
    rng = np.random.default_rng(seed)
    a, b = np.repeat(np.arange(len(graph)), graph.shape[1]), graph.reshape(-1)
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    label = np.zeros(len(graph), dtype=np.int64)
    n = 1
    while n < parts:
        for part in range(n):
            nodes = np.flatnonzero(label == part)
            if len(nodes) < 2:
                continue
            place = np.full(len(graph), -1)
            place[nodes] = np.arange(len(nodes))
            inside = (place[a] >= 0) & (place[b] >= 0)
            i, j = place[a[inside]], place[b[inside]]
            degree = np.bincount(i, minlength=len(nodes)) + 1.0
            v = rng.standard_normal(len(nodes))
            for _ in range(80):
                # Lazy random walk with the constant part taken out.
                v = 0.5 * v + 0.5 * (np.bincount(i, weights=v[j], minlength=len(nodes)) + v) / degree
                v -= (v * degree).sum() / degree.sum()
                v /= np.linalg.norm(v) + 1e-300
            upper = np.argsort(v, kind="stable")[len(nodes) // 2:]
            label[nodes[upper]] = part + n
        n *= 2
    return label


def features(x: np.ndarray) -> np.ndarray:
    """Direction, length and a constant."""
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.concatenate([x / norm, np.log(norm), np.ones((len(x), 1))], axis=1)


def train_classifier(x: np.ndarray, label: np.ndarray, parts: int, rounds: int) -> np.ndarray:
    """Softmax regression by full-batch gradient steps with momentum."""
    f, w = features(x), np.zeros((x.shape[1] + 2, parts))
    truth, speed = np.eye(parts)[label], np.zeros_like(w)
    for _ in range(rounds):
        z = f @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        speed = 0.9 * speed - 8.0 * (f.T @ (p - truth) / len(f) + 1e-5 * w)
        w += speed
    return w


@dataclass(frozen=True)
class Router:
    """A learned classifier and how many parts to probe."""

    weights: np.ndarray
    probes: int

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """Parts from the most probable down."""
        return np.argsort(-(features(x) @ self.weights), axis=1, kind="stable")


def learn(x: np.ndarray, k: int, fit: Fit) -> Router:
    """A router from sample rows ``x``."""
    x = np.unique(x, axis=0)
    if len(x) < 4 * fit.parts or len(x) <= k:
        return Router(np.zeros((x.shape[1] + 2, 1)), 1)
    graph = neighbour_graph(x, max(k, fit.graph_neighbours))
    weights = train_classifier(x, balanced_parts(graph[:, :fit.graph_neighbours], fit.parts), fit.parts, fit.rounds)
    ranked = Router(weights, 1).ranked(x)
    home = ranked[:, 0]
    place = np.empty_like(ranked)
    np.put_along_axis(place, ranked, np.arange(fit.parts)[None, :].repeat(len(x), 0), 1)
    # The probe at which each true neighbour's part comes up.
    found_at = np.take_along_axis(place, home[graph[:, :k]], 1)
    recall = np.array([(found_at < m).mean() for m in range(1, fit.parts + 1)])
    enough = np.flatnonzero(recall >= fit.target_recall)
    return Router(weights, int(enough[0]) + 1 if len(enough) else fit.parts)


def usable(rows: DataFrame, id_column: str, vector: str) -> tuple[DataFrame, int]:
    """(vec_id, v: array<double>) of the rows that take part, and how many they are."""
    bad = F.exists(vector, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    some = F.exists(vector, lambda e: e != 0)
    good = rows.where(F.col(vector).isNotNull() & (F.size(vector) > 0)).where(~bad & some & F.col(id_column).isNotNull())
    sizes = good.groupBy(F.size(vector).alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "n").first()
    known = good.where(F.size(vector) == (sizes["n"] if sizes else 0)).select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    return known, sizes["c"] if sizes else 0


def sampled(known: DataFrame, rows: int, sample: int) -> DataFrame:
    """The ``sample`` ids with the smallest hashes, one vector each. Only ids under the cut, about
    a quarter more, are ranked, however many rows and tasks there are."""
    under = known.where(F.xxhash64("vec_id") <= hash_cut(1.25 * sample + 200, rows))
    return under.groupBy("vec_id").agg(F.min("v").alias("v")).orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def needed_copies(x: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The rows that can be among the k nearest of some query, if equal vectors
    are taken from the smallest id up: k of each distinct vector and, as a query
    never meets rows with its own id, as many more as one id has there."""
    bits = np.ascontiguousarray(x + 0.0).view(np.dtype((np.void, x.shape[1] * x.itemsize))).reshape(-1)
    _, which = np.unique(bits, return_inverse=True)
    order = np.lexsort((ids, which))
    v, i = which[order], ids[order]
    new_vector = np.append(True, v[1:] != v[:-1])
    new_id = new_vector | np.append(True, i[1:] != i[:-1])
    firsts = np.flatnonzero(new_id)
    repeats = np.zeros(v.max() + 1, dtype=np.int64)
    np.maximum.at(repeats, v[firsts], np.minimum(np.diff(np.append(firsts, len(v))), k))
    # Of one id, rows after the k-th are never needed.
    of_id = np.arange(len(v)) - np.repeat(firsts, np.diff(np.append(firsts, len(v))))
    order, v = order[of_id < k], v[of_id < k]
    place = np.arange(len(v)) - np.searchsorted(v, v)
    return np.sort(order[place < k + repeats[v]])


def search(rows: DataFrame, is_query, k: int, fit: Fit = Fit(), id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k nearest rows of each row for which ``is_query`` (a column over
    ``vec_id``) holds: (query_id, rank, vec_id, score)."""
    known, n_known = usable(rows, id_column, vector)
    sample = sampled(known, n_known, fit.sample).collect()
    if not sample:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    router = learn(np.array([r["v"] for r in sample]), k, fit)
    parts = router.weights.shape[1]

    def route(batches):
        for batch in batches:
            home = router.ranked(_matrix(batch.column(1)))[:, 0]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(home.astype("int32"))], names=["vec_id", "v", "home"])

    index = materialize(known.mapInArrow(route, "vec_id long, v array<double>, home int"), "vectors")
    # Two rows per part come to the driver, and part numbers are bounded by ``fit.parts``.
    n_rows = {r["home"]: r["n"] for r in index.groupBy("home").agg(F.count(F.lit(1)).alias("n")).collect()}
    # A query never meets rows with its own id: so many more must be in its parts.
    own_rows = index.where(is_query).groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    held = np.array([n_rows.get(p, 0) for p in range(parts)])

    def probe(batches):
        for batch in batches:
            ranked = router.ranked(_matrix(batch.column(1)))
            before = np.cumsum(held[ranked], axis=1) - held[ranked]
            taken = (np.arange(parts) < router.probes) | (before < k + own_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([r[t].astype("int32") for r, t in zip(ranked, taken)], pa.list_(pa.int32()))],
                names=["vec_id", "v", "probes"])

    asked = index.where(is_query).select("vec_id", "v").mapInArrow(probe, "vec_id long, v array<double>, probes array<int>").select(
        "vec_id", "v", F.explode("probes").alias("part"))
    n_asked = {r["part"]: r["n"] for r in asked.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    grid = [(p, buckets_for(n_rows.get(p, 0), ROWS_PER_CELL), buckets_for(n_asked.get(p, 0), QUERIES_PER_CELL)) for p in range(parts)]
    cells = rows.sparkSession.createDataFrame(grid, "part int, row_blocks long, query_blocks long")
    own = lambda blocks: F.pmod(F.xxhash64("vec_id"), F.col(blocks))
    each = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    stored = index.join(cells, F.col("home") == F.col("part")).select(
        "part", own("row_blocks").alias("i"), each("query_blocks").alias("j"), F.lit(0).alias("side"), "vec_id", "v")
    wanted = asked.join(cells, "part").select(
        "part", each("row_blocks").alias("i"), own("query_blocks").alias("j"), F.lit(1).alias("side"), "vec_id", "v")
    dealt = stored.union(wanted).repartition("part", "i", "j").sortWithinPartitions("part", "i", "j", "side")

    def compare(batches):
        for _, cell in _by_key(batches, 3):
            side = np.array([r[0] for r in cell])
            ids = np.array([r[1] for r in cell], dtype=np.int64)
            x, q = ([cell[i][2] for i in np.flatnonzero(side == s)] for s in (0, 1))
            if x and q:
                yield from nearest(np.array(x), ids[side == 0], np.array(q), ids[side == 1])

    def nearest(x, x_ids, q, q_ids):
        used = needed_copies(x, x_ids, k)
        x, x_ids = x[used], x_ids[used]
        for lo in range(0, len(q), 256):
            some, some_ids = q[lo:lo + 256], q_ids[lo:lo + 256]
            rough = some @ x.T
            rough[some_ids[:, None] == x_ids[None, :]] = -np.inf
            kth = -np.partition(-rough, min(k, rough.shape[1]) - 1, axis=1)[:, min(k, rough.shape[1]) - 1]
            # Products differ in their last bits with the order of summing: keep
            # what may tie with the k-th, then compare sums made in one order.
            slack = 1e-9 * np.linalg.norm(some, axis=1) * np.linalg.norm(x, axis=1).max()
            a, b = np.nonzero((rough >= (kth - slack)[:, None]) & (rough > -np.inf))
            score = np.empty(len(a))
            step = max(1, RESCORED // x.shape[1])
            for at in range(0, len(a), step):
                score[at:at + step] = (some[a[at:at + step]] * x[b[at:at + step]]).sum(axis=1)
            order = np.lexsort((x_ids[b], -score, a))
            a, b, score = a[order], b[order], score[order]
            rank = np.arange(len(a)) - np.searchsorted(a, a)
            top = rank < k
            yield pa.RecordBatch.from_arrays([pa.array(some_ids[a[top]]), pa.array(x_ids[b[top]]), pa.array(score[top])], names=["query_id", "vec_id", "score"])

    found = dealt.select("part", "i", "j", "side", "vec_id", "v").mapInArrow(compare, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
