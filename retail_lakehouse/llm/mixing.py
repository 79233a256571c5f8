"""Mixing sources to target weights over fixed-length blocks.

Each source's documents, in a fixed order, are one stream of words that is
packed into blocks of ``block_words`` (the last may be shorter). Every output
shard draws a multinomial count of blocks per source, given that all shards together
end exactly on the targets: a binary tree of shard ranges, each node with a seed of its own, splits the
blocks, so tasks draw their own shards. A
source's draws are numbered slots; slot i takes the block that the source's
pseudorandom permutation of epoch i // n puts at place i % n, so no block is
taken again before all were taken once. Slots and blocks are joined by (source,
block index).

A source may hold a third of all rows: stream positions are prefix sums over
hash buckets of bounded size, added to the sums of the buckets before; slots and
blocks are spread by block. The driver handles one row per source.

Defined results: null text has no words and is never taken; a null source is a
source of its own, last in order; equal rows are separate documents; a source
without words gets target 0; an empty table gives an empty result. Everything
follows from ids, sizes and the seed: reruns agree.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_lakehouse.llm.common import NOT_SPACE, buckets_for, free_name, materialize, numbered
from retail_lakehouse.llm.tokens import slices, strings

ROWS_PER_BUCKET = 100_000
TEXT_BYTES = 4_000_000  # text cut at a time
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


@dataclass(frozen=True)
class Mix:
    """How to mix: weights repeat over the sources in order; ``share`` is the
    output size as a multiple of the input; no source beyond ``cap`` times its size."""

    weights: tuple = (3, 1, 2)
    share: Fraction = Fraction(3, 2)
    cap: int = 2
    block_words: int = 64
    blocks_per_shard: int = 1 << 18
    seed: int = 17


def targets(sizes: list[int], mix: Mix) -> list[Fraction]:
    """Targets per source by weight; where one would pass its cap, the excess
    goes to the others by weight, until none is above."""
    weights = [Fraction(mix.weights[i % len(mix.weights)]) for i in range(len(sizes))]
    caps = [Fraction(mix.cap * s) for s in sizes]
    left, open_ = mix.share * sum(sizes), set(range(len(sizes)))
    out = [Fraction(0)] * len(sizes)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if unit * weights[i] >= caps[i]}
        if not full:
            for i in open_:
                out[i] = unit * weights[i]
            break
        for i in full:
            out[i] = caps[i]
        left -= sum(caps[i] for i in full)
        open_ -= full
    return out


def dealt(counts: np.ndarray, want: int, rng: np.random.Generator) -> np.ndarray:
    """``want`` of ``counts`` blocks per source: each block by a coin of that bias, and what the
    coins miss or exceed ``want`` by in multinomial draws over the blocks that may still move."""
    half = rng.binomial(counts, want / counts.sum())
    while lack := want - int(half.sum()):
        free = counts - half if lack > 0 else half
        moved = np.minimum(rng.multinomial(abs(lack), free / free.sum()), free)
        half += moved if lack > 0 else -moved
    return half


def shards_of(quota: np.ndarray, blocks_per_shard: int) -> int:
    return buckets_for(int(quota.sum()), blocks_per_shard) if quota.sum() else 0


def shard_draws(quota: np.ndarray, blocks_per_shard: int, seed: int, lo: int, hi: int):
    """(shard, first slot per source, blocks per source) of the shards from ``lo`` to before ``hi``.

    The shards are the leaves of a binary tree. A node, seeded by its range, deals its
    blocks to its two halves, so anyone can draw any range by the nodes above it alone; all
    draws together are the quotas, and each shard's counts are multinomial given that."""
    open_ = [(0, shards_of(quota, blocks_per_shard), quota.astype(np.int64), np.zeros(len(quota), dtype=np.int64))]
    while open_:
        a, b, counts, first = open_.pop()
        if b <= lo or a >= hi:
            continue
        if b - a == 1:
            yield a, first, counts
            continue
        mid = (a + b) // 2
        left = dealt(counts, (mid - a) * blocks_per_shard, np.random.default_rng([seed, a, b]))
        open_ += [(mid, b, counts - left, first + left), (a, mid, left, first)]


def shard_counts(quota: np.ndarray, blocks_per_shard: int, seed: int) -> np.ndarray:
    """Blocks per (shard, source), all shards."""
    rows = [counts for _, _, counts in shard_draws(quota, blocks_per_shard, seed, 0, shards_of(quota, blocks_per_shard))]
    return np.array(rows, dtype=np.int64).reshape(len(rows), len(quota))


def permuted(place: np.ndarray, n: int, key: int) -> np.ndarray:
    """The pseudorandom permutation of 0..n-1 that ``key`` names, at ``place``: a
    four-round Feistel network on the next even number of bits, stepped again
    while it leaves the range."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)

    def network(x):
        left, right = x >> np.uint64(half), x & mask
        for r in range(4):
            h = right * np.uint64(0x9E3779B97F4A7C15) + np.uint64((key * 4 + r) * 0xBF58476D1CE4E5B9 % 2 ** 64)
            h ^= h >> np.uint64(29)
            h *= np.uint64(0x94D049BB133111EB)
            h ^= h >> np.uint64(32)
            left, right = right, left ^ (h & mask)
        return (left << np.uint64(half)) | right

    x = network(place.astype(np.uint64))
    out = x >= np.uint64(n)
    while out.any():
        x[out] = network(x[out])
        out = x >= np.uint64(n)
    return x.astype(np.int64)


def sized(docs: DataFrame, row: str | None = None) -> DataFrame:
    """(row__, doc_id, source, size): words per document, written once. ``row`` names a
    column that tells the rows apart, otherwise they are numbered here."""
    number = F.col(row) if row else F.monotonically_increasing_id()
    words = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(NOT_SPACE)).cast("long")
    return materialize(docs.select(number.alias("row__"), "doc_id", "source", words.alias("size")), "sizes")


def source_plan(sizes: DataFrame, mix: Mix) -> list[dict]:
    """Per source in code point order, null last: sid, size, target, blocks, quota (blocks to take)."""
    rows = [(r["source"], int(r["size"])) for r in sizes.groupBy("source").agg(F.sum("size").alias("size")).collect()]
    rows.sort(key=lambda r: (r[0] is None, r[0] or ""))
    plan = []
    for sid, ((source, size), target) in enumerate(zip(rows, targets([s for _, s in rows], mix))):
        blocks = -(-size // mix.block_words)
        quota = min(mix.cap * blocks, round(target * blocks / size)) if size else 0
        plan.append({"sid": sid, "source": source, "source_size": size, "target": float(target),
                     "blocks": blocks, "quota": quota})
    return plan


def positions(sizes: DataFrame, plan: list[dict]) -> DataFrame:
    """``sizes`` with sid, source_size, target and ``begin``, the place of the
    document's first word in its source's stream."""
    spark = sizes.sparkSession
    sources = spark.createDataFrame(
        [(p["sid"], p["source"], p["source_size"], p["target"]) for p in plan],
        "sid int, source string, source_size long, target double")
    known = sizes.join(sources.withColumnRenamed("source", "name__"), F.col("source").eqNullSafe(F.col("name__"))).drop("name__")
    rows = sizes.count()
    bucket = F.pmod(F.xxhash64("doc_id", "row__"), F.lit(buckets_for(rows, ROWS_PER_BUCKET))).cast("int")
    known = known.withColumn("bucket__", bucket)
    earlier = Window.partitionBy("sid", "bucket__").orderBy("doc_id", "row__").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("sid").orderBy("bucket__").rowsBetween(Window.unboundedPreceding, -1)
    bases = (known.groupBy("sid", "bucket__").agg(F.sum("size").alias("sum__"))
             .select("sid", "bucket__", F.coalesce(F.sum("sum__").over(before), F.lit(0)).alias("base__")))
    local = known.withColumn("local__", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    return local.join(bases, ["sid", "bucket__"]).withColumn("begin", F.col("base__") + F.col("local__")).drop(
        "bucket__", "base__", "local__")


def block_segments(placed: DataFrame, mix: Mix) -> DataFrame:
    """What each block holds: (sid, block, row__, first, words), ``first`` being
    the segment's first word within its document."""
    b = mix.block_words
    end = F.col("begin") + F.col("size")
    each = placed.where("size > 0").select("sid", "row__", "begin", end.alias("end"), F.explode(
        F.sequence(F.floor(F.col("begin") / b), F.floor((end - 1) / b))).alias("block"))
    lo, hi = F.greatest(F.col("begin"), F.col("block") * b), F.least(F.col("end"), (F.col("block") + 1) * b)
    return each.select("sid", "block", "row__", (lo - F.col("begin")).alias("first"), (hi - lo).alias("words"))


def drawn_slots(spark, plan: list[dict], mix: Mix) -> DataFrame:
    """(shard, sid, slot, block): every slot of every output shard with the block it takes.
    Tasks draw for their own shards; the driver sends them quota and blocks of each source."""
    quota, blocks = (np.array([p[c] for p in plan], dtype=np.int64) for c in ("quota", "blocks"))
    shards = shards_of(quota, mix.blocks_per_shard)

    def taken(sid, slot):
        epoch, place, out = slot // blocks[sid], slot % blocks[sid], np.zeros(len(slot), dtype=np.int64)
        for e in np.unique(epoch).tolist():
            mine = epoch == e
            out[mine] = permuted(place[mine], int(blocks[sid]), hash_key(mix.seed, sid, e))
        return out

    def slots(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for shard, first, counts in shard_draws(quota, mix.blocks_per_shard, mix.seed, int(ids[0]), int(ids[-1]) + 1):
                parts = [(sid, np.arange(first[sid], first[sid] + counts[sid])) for sid in np.flatnonzero(counts).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(counts.sum(), shard)), pa.array(np.repeat(np.arange(len(quota), dtype="int32"), counts)),
                     pa.array(np.concatenate([slot for _, slot in parts])),
                     pa.array(np.concatenate([taken(sid, slot) for sid, slot in parts]))], names=["shard", "sid", "slot", "block"])

    tasks = max(1, min(shards, 4 * spark.sparkContext.defaultParallelism))
    return spark.range(0, shards, 1, tasks).mapInArrow(slots, "shard long, sid int, slot long, block long")


def hash_key(seed: int, sid: int, epoch: int) -> int:
    return (seed * 1_000_003 + sid) * 1_000_003 + epoch


def segment_uses(docs: DataFrame, mix: Mix, row: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents with their place, segments with ``uses``: how often the mix takes each)."""
    sizes = sized(docs, row)
    plan = source_plan(sizes, mix)
    placed = positions(sizes, plan)
    uses = drawn_slots(docs.sparkSession, plan, mix).groupBy("sid", "block").agg(F.count(F.lit(1)).alias("uses"))
    # The planner takes the slots for as small as the draws they come from: never broadcast them.
    return placed, block_segments(placed, mix).join(uses.hint("merge"), ["sid", "block"])


def mixed_blocks(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself: (shard, sid, slot, block, segments), a block's segments
    being (row__, first, words) of the documents it covers, in stream order."""
    sizes = sized(docs)
    plan = source_plan(sizes, mix)
    held = block_segments(positions(sizes, plan), mix).groupBy("sid", "block").agg(
        F.array_sort(F.collect_list(F.struct("row__", "first", "words"))).alias("segments"))
    return drawn_slots(docs.sparkSession, plan, mix).hint("merge").join(held, ["sid", "block"])


def taken_words(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per row of ``docs``: (doc_id, row__, size, source_size, target, taken)."""
    placed, segments = segment_uses(docs, mix)
    taken = segments.groupBy("row__").agg(F.sum(F.col("words") * F.col("uses")).alias("taken"))
    return placed.join(taken.hint("merge"), "row__", "left").select(
        "doc_id", "row__", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def cut_text(text: str, segments: list[tuple[int, int, int]]) -> str:
    """The words that (first, words, uses) segments take from ``text``: the
    first use of all of them in order, then the second, ...; neighbours taken
    together keep the white space between them."""
    spans = [m.span() for m in _WORD.finditer(text)]
    out, epoch = [], 0
    while True:
        runs: list[list[int]] = []
        for first, words, uses in sorted(segments):
            if uses > epoch:
                if runs and runs[-1][1] == first:
                    runs[-1][1] = first + words
                else:
                    runs.append([first, first + words])
        if not runs:
            return "\n".join(out)
        out += [text[spans[a][0]:spans[b - 1][1]] for a, b in runs]
        epoch += 1


def mixed_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``docs`` with each text replaced by the words the mix takes from it and
    ``n_chars`` (if there) by their length; documents not taken are left out."""
    rows, row = numbered(docs)
    _, segments = segment_uses(rows, mix, row)
    held = free_name(rows.columns, "segments__")
    lists = segments.groupBy(F.col("row__").alias(row)).agg(F.collect_list(F.struct("first", "words", "uses")).alias(held))
    # Most rows are taken from: a sort-merge join at every size.
    both = rows.join(lists.hint("merge"), row).select(
        *docs.columns, *[F.col(held)[f].alias(free_name(docs.columns, f"{f}__")) for f in ("first", "words", "uses")])
    names = list(docs.columns)
    at, kept = names.index("text"), len(names)

    def take(batches):
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                lists = part.columns[kept:]
                ends = lists[0].offsets.to_numpy()
                first, words, uses = (c.values.to_numpy() for c in lists)
                texts = [cut_text(t, list(zip(first[a:b].tolist(), words[a:b].tolist(), uses[a:b].tolist())))
                         for t, a, b in zip(strings(part.column(at)), ends, ends[1:])]
                columns = list(part.columns[:kept])
                columns[at] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=names)

    out = both.mapInArrow(take, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
