"""Best-fit packing: vector best-fit of token pieces into fixed-length sequences.

An item demands (tokens, documents, attention cost) = (L, 1, L * L); a bin has
a capacity for each. Items are taken longest first; among the bins with room
under every constraint, the one with the largest weighted dot product of
demand and residual ("dot"), or with the smallest weighted norm of the residual
that is left ("norm"), gets the item; a new bin opens when none has room.

Demand depends on the length alone, so items of one length are alike, and so
are bins with equal contents. ``plan_bins`` therefore runs on the histogram of
lengths (at most ``tokens`` rows, whatever the corpus) with bins held as
(contents, how many): the same result as item by item, in bounded work. Every
piece is then ranked within its length (salted, so that a length that holds a
third of all pieces is ranked by many tasks) and looks up its bin and place.

Defined results: null and empty texts are one piece holding the end id; equal
rows are packed as separate items; an empty table gives an empty result; a
document longer than a sequence is cut, the first piece taking the remainder.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_lakehouse.llm.common import buckets_for, materialize, text_table
from retail_lakehouse.llm.tokens import encoder, slices

ROWS_PER_SALT = 200_000


@dataclass(frozen=True)
class Capacity:
    """What one sequence may hold of each resource."""

    tokens: int
    documents: int
    attention: int

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], dtype=np.float64)


def demand(length: int) -> np.ndarray:
    return np.array([length, 1, length * length], dtype=np.float64)


def average_demand_weights(histogram: dict[int, int], capacity: Capacity) -> np.ndarray:
    """A resource weighs as much as the items ask of it on the whole."""
    total = sum(demand(length) * count for length, count in histogram.items()) / capacity.vector()
    return total / total.sum()


def _copies(residual: np.ndarray, need: np.ndarray) -> np.ndarray:
    """How many copies of an item fit each residual, under every constraint."""
    return np.floor(residual / need + 1e-9).min(axis=-1).astype(np.int64)


def plan_bins(histogram: dict[int, int], capacity: Capacity, rule: str, weights: np.ndarray) -> list[tuple]:
    """Vector best-fit on a histogram: [(contents, bins)], contents being
    ((length, copies), ...) in order of placement."""
    caps = capacity.vector()
    # Groups of alike bins: residuals row by row, contents and counts beside them.
    residual = np.zeros((1024, 3))
    bins = np.zeros(1024, dtype=np.int64)
    contents: list[tuple] = []

    def add(res: np.ndarray, what: tuple, count: int) -> None:
        nonlocal residual, bins
        n = len(contents)
        if n == len(bins):
            residual, bins = np.concatenate([residual, np.zeros_like(residual)]), np.concatenate([bins, np.zeros_like(bins)])
        residual[n], bins[n] = res, count
        contents.append(what)

    for length in sorted(histogram, reverse=True):
        left, need = histogram[length], demand(length)
        if (need > caps).any():
            raise ValueError(f"an item of {length} tokens exceeds the capacity {capacity}")
        while left:
            n = len(contents)
            fits = np.flatnonzero((residual[:n] >= need).all(axis=1) & (bins[:n] > 0))
            if not len(fits):
                # New bins: the one just opened is the only one with room until it is full.
                per = int(_copies(caps, need))
                opened, rest = divmod(left, per)
                if opened:
                    add(caps - per * need, ((length, per),), opened)
                    left -= opened * per
                if rest:
                    add(caps - rest * need, ((length, rest),), 1)
                    left -= rest
                continue
            if rule == "norm":
                g = int(fits[np.argmin((((residual[fits] - need) / caps) ** 2 * weights).sum(axis=1))])
                # The bin just filled is the tightest, so it takes all it can.
                per = int(_copies(residual[g], need))
            else:
                # A bin that takes one falls behind its equals, so each of them takes one.
                g = int(fits[np.argmax(((residual[fits] / caps) * (need / caps) * weights).sum(axis=1))])
                per = 1
            full = min(int(bins[g]), left // per)
            rest = left - full * per if full < bins[g] else 0
            res, what = residual[g].copy(), contents[g]
            bins[g] -= full + (1 if rest else 0)
            if full:
                add(res - per * need, (*what, (length, per)), full)
            if rest:
                add(res - rest * need, (*what, (length, rest)), 1)
            left -= full * per + rest
    return [(what, int(count)) for what, count in zip(contents, bins) if count]


def best_plan(histogram: dict[int, int], capacity: Capacity, weights=None) -> list[tuple]:
    """The plan with the fewest bins over the selection rules and weightings."""
    if not histogram:
        return []
    tries = [np.asarray(weights, dtype=np.float64)] if weights is not None else [
        np.array([1.0, 0.0, 0.0]), average_demand_weights(histogram, capacity)]
    plans = [plan_bins(histogram, capacity, rule, w) for rule in ("norm", "dot") for w in tries]
    return min(plans, key=lambda p: sum(c for _, c in p))


def _lookup(plan: list[tuple]) -> dict[str, np.ndarray]:
    """For each length, which ranks go to which bins: rows sorted by (length, first rank)."""
    rows, taken, base = [], {}, 0
    for what, count in plan:
        place = 0
        for length, per in what:
            lo = taken.get(length, 0)
            rows.append((length, lo, per, base, place))
            taken[length] = lo + per * count
            place += per * length
        base += count
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return {k: cols[:, i] for i, k in enumerate(("length", "lo", "per", "base", "place"))}


def token_pieces(docs: DataFrame, tokenizer: str, max_tokens: int, end_id: int, keep_ids: bool = False) -> DataFrame:
    """Cut every document's ids (its text's ids, then ``end_id``) into pieces of
    at most ``max_tokens``: (doc_id, piece, start, length, ids_crc32[, ids])."""
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64())] + ([("ids", pa.list_(pa.int64()))] if keep_ids else [])
    schema = pa.schema(fields)

    def cut(batches):
        enc = encoder(tokenizer)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, counts = enc.encode(part.column(1))
                out, at = [[] for _ in fields], 0
                for doc, n in zip(part.column(0).to_pylist(), counts.tolist()):
                    mine = np.append(ids[at:at + n], np.uint32(end_id)).astype("<u4")
                    at += n
                    first = len(mine) % max_tokens or max_tokens
                    begins = [0, *range(first, len(mine), max_tokens)]
                    for k, (b, e) in enumerate(zip(begins, [*begins[1:], len(mine)])):
                        row = [doc, k, b, e - b, zlib.crc32(mine[b:e].tobytes())]
                        for col, v in zip(out, row + ([mine[b:e].tolist()] if keep_ids else [])):
                            col.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(out, schema)], schema=schema)

    spark_schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<long>" if keep_ids else "")
    return text_table(docs, "doc_id", "text").mapInArrow(cut, spark_schema)


def pack(pieces: DataFrame, capacity: Capacity, weights=None) -> DataFrame:
    """Add (sequence_id, offset) to ``pieces``, a stable table with an integer
    ``length`` and the order columns ``doc_id``, ``piece``.

    To the driver comes one row per distinct length (at most ``capacity.tokens``);
    the plan that goes back has a few entries per length."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = _lookup(best_plan(histogram, capacity, weights))
    salts = buckets_for(sum(histogram.values()), ROWS_PER_SALT)
    salted = pieces.withColumn("salt__", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt__").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (salted.groupBy("length", "salt__").agg(F.count(F.lit(1)).alias("n__"))
               .select("length", "salt__", F.coalesce(F.sum("n__").over(before), F.lit(0)).alias("before__")))
    ranked = (salted.withColumn("rank__", F.row_number().over(
        Window.partitionBy("length", "salt__").orderBy("doc_id", "piece")) - 1)
        .join(offsets, ["length", "salt__"])
        .withColumn("rank__", F.col("rank__") + F.col("before__")).drop("before__", "salt__"))
    schema = ranked.drop("rank__").schema.add("sequence_id", "long").add("offset", "long")

    def place(batches):
        # Ranks of one length are consecutive entries: search both at once.
        starts = np.searchsorted(table["length"], np.unique(table["length"]))
        bounds = {int(table["length"][s]): (int(s), int(e)) for s, e in zip(starts, [*starts[1:], len(table["length"])])}
        for batch in batches:
            names = batch.schema.names
            length = batch.column(names.index("length")).to_numpy()
            rank = batch.column(names.index("rank__")).to_numpy()
            at = np.zeros(len(length), dtype=np.int64)
            for v in np.unique(length).tolist():
                mine, (s, e) = length == v, bounds[v]
                at[mine] = s + np.searchsorted(table["lo"][s:e], rank[mine], side="right") - 1
            within = rank - table["lo"][at]
            seq = table["base"][at] + within // table["per"][at]
            offset = table["place"][at] + (within % table["per"][at]) * length
            keep = [batch.column(i) for i, n in enumerate(names) if n != "rank__"]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(seq, pa.int64()), pa.array(offset, pa.int64())],
                names=[n for n in names if n != "rank__"] + ["sequence_id", "offset"])

    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: Capacity, end_id: int = 0, weights=None,
                   keep_ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack ``docs`` (doc_id, text). The pieces are written to
    the shared checkpoint folder, as the plan and the placement must see the same."""
    pieces = materialize(token_pieces(docs, tokenizer, capacity.tokens, end_id, keep_ids), "pieces")
    return pack(pieces, capacity, weights)
