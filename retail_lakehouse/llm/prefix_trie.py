"""Prefix trie of rebuilt conversations, its subtree totals by time-forward processing.

A conversation is rebuilt from the first turns of its hundred's first conversation
(``conv_id - conv_id % 100``) and its own later ones. A node of the trie is a distinct
beginning of rebuilt conversations, named by 128 bits of a SHA-256 chain over its
turns. Texts are read once, to be hashed; what is shuffled is a digest per turn.

* Turns are placed by a range sort over (conv_id, turn, digest), so one conversation
  with a third of all rows is sorted by many tasks. Chains run in blocks of
  ``BLOCK`` turns; a block is then told what comes before it.
* Nodes are counted with partial sums, so a beginning that a third of the
  conversations share is one row per task.
* Subtree totals: a node of one member heads a chain, whose totals are known. The
  other nodes are cut into shards: *heavy* nodes, of more members than fit one shard
  (``rows / HEAVY_NODES`` at least, so there are at most HEAVY_NODES of them), and below
  them whole subtrees of light nodes. A task sorts its shards' nodes by reverse level
  order (Spark's external sort) and sends each node's totals forward to its parent
  through a priority queue that spills sorted runs; then the same pass runs once across the shard
  roots' parents, the heavy nodes.

Defined results: rows with null conv_id take no part; turns of equal number come in
the order of the SHA-256 of role and text, repeated rows stay; null role or text is
empty; ``%`` keeps the sign of a negative id; an empty table has no nodes; further columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lakehouse.llm.common import materialize
from retail_lakehouse.operators.ntile import row_positions

HUNDRED = 100
HEADS = 6  # a conversation takes crc32(id) % HEADS first turns
BLOCK = 1024
HEAVY_NODES = 131_072
LEAST_SHARD = 1000
QUEUE = 200_000
ENDS_BITS = 10  # ids of 1024 neighbouring conversations are joined at once
ROOT = bytes(16)

_RECORD = struct.Struct(">q16sqq")


def chained(before: bytes, turn: bytes) -> bytes:
    return hashlib.sha256(before + turn).digest()[:16]


def chained_column(before, turn):
    """The same in Spark."""
    return F.substring(F.unhex(F.sha2(F.concat(before, turn), 256)), 1, 16)


# --- rebuilt conversations ------------------------------------------------------

def turn_digests(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, chars), one row per turn."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.unhex(F.sha2(said, 256)).alias("digest"),
        F.length(text).cast("long").alias("chars"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, length) of every rebuilt conversation, and its turns (conv_id, depth from 1, digest, chars, last)."""
    placed = row_positions(turn_digests(conversations), ["conv_id", F.col("turn").asc_nulls_first(), "digest"])
    found = placed.groupBy("conv_id").agg(F.min("_pos").alias("start"), F.count(F.lit(1)).alias("n"))
    found = found.withColumn("base", F.col("conv_id") - F.col("conv_id") % HUNDRED)
    bases = found.where("conv_id = base").select("base", F.col("n").alias("base_n"))
    own = F.col("conv_id") == F.col("base")
    wanted = F.when(own, 0).otherwise(F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS)
    joined = found.join(bases, "base", "left").withColumn("skip", wanted)
    joined = joined.withColumn("head", F.least("skip", F.coalesce("base_n", F.lit(0).cast("long"))))
    convs = materialize(joined.select(
        "conv_id", "base", "start", "skip", "head",
        (F.col("head") + F.greatest(F.col("n") - F.col("skip"), F.lit(0).cast("long"))).alias("length")), "conversations")
    turns = placed.join(convs, "conv_id").withColumn("at", F.col("_pos") - F.col("start"))
    later = turns.where(F.col("at") >= F.col("skip")).select(
        "conv_id", (F.col("head") + F.col("at") - F.col("skip") + 1).alias("depth"), "digest", "chars", "length")
    heads = turns.where((F.col("conv_id") == F.col("base")) & (F.col("at") < HEADS)).select("base", "at", "digest", "chars")
    taken = heads.join(convs.select("base", "conv_id", "head", "length"), "base").where("at < head").select(
        "conv_id", (F.col("at") + 1).alias("depth"), "digest", "chars", "length")
    rows = later.unionByName(taken)
    return convs.select("conv_id", "length"), rows.select(
        "conv_id", "depth", "digest", "chars", (F.col("depth") == F.col("length")).alias("last"))


def members(convs: DataFrame, turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, depth, node, parent, chars, last): each conversation's path from the root."""
    schema = "conv_id long, depth long, block long, node binary, parent binary, chars long, last boolean"

    def chain(batches):
        key, node = None, ROOT
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in ("conv_id", "block", "digest")}
            nodes, parents = [], []
            for conv, at, digest in zip(columns["conv_id"], columns["block"], columns["digest"]):
                if key != (conv, at):
                    key, node = (conv, at), ROOT
                parents.append(node)
                node = chained(node, digest)
                nodes.append(node)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("depth"), batch.column("block"), pa.array(nodes, pa.binary()),
                 pa.array(parents, pa.binary()), batch.column("chars"), batch.column("last")],
                names=["conv_id", "depth", "block", "node", "parent", "chars", "last"])

    def states(batches):
        conv, state = None, ROOT
        for batch in batches:
            out = []
            for c, at, node in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                state = node if c != conv else chained(state, node)  # the first block's chain begins at the root
                conv = c
                out.append(state)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())],
                                             names=["conv_id", "block", "state"])

    # Whole numbers stay long: `div`, not `/`.
    dealt = turns.withColumn("block", F.expr(f"(depth - 1) div {block}"))
    dealt = dealt.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "depth")
    rows = materialize(dealt.mapInArrow(chain, schema), "chains")
    full = rows.where((F.col("depth") % block == 0) & ~F.col("last")).select("conv_id", "block", "node")
    before = full.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(
        states, "conv_id long, block long, state binary").withColumn("block", F.col("block") + 1)
    opens = (F.col("depth") - 1) % block == 0
    later = rows.where("block > 0").join(before, ["conv_id", "block"]).select(
        "conv_id", "depth", chained_column(F.col("state"), F.col("node")).alias("node"),
        F.when(opens, F.col("state")).otherwise(chained_column(F.col("state"), F.col("parent"))).alias("parent"), "chars", "last")
    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("node"),
                        F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("chars"),
                        (F.col("length") == 0).alias("last"))
    return rows.where("block = 0").drop("block").unionByName(later).unionByName(root)


# --- time-forward processing -----------------------------------------------------

class SpillingQueue:
    """Messages (level, node, leaves, saved) in ascending order. Beyond ``limit`` of
    them in memory, the queue writes them as a sorted run to an unnamed scratch
    file of the task (gone with it; nothing else reads it) and merges the runs' heads on the way out."""

    def __init__(self, limit: int = QUEUE):
        self.limit, self.heap, self.heads, self.runs = limit, [], [], []

    def push(self, message: tuple[int, bytes, int, int]) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        run = tempfile.TemporaryFile()
        for m in sorted(self.heap):
            run.write(_RECORD.pack(*m))
        run.seek(0)
        self.heap = []
        self.runs.append(self._read(run))
        self._advance(len(self.runs) - 1)

    @staticmethod
    def _read(run):
        with run:
            while block := run.read(_RECORD.size * 1000):
                yield from _RECORD.iter_unpack(block)

    def _advance(self, k: int) -> None:
        message = next(self.runs[k], None)
        if message is not None:
            heapq.heappush(self.heads, (message, k))

    def take(self, level: int, node: bytes):
        """All messages to ``node``; earlier ones have been taken before."""
        while True:
            spilled = bool(self.heads) and (not self.heap or self.heads[0][0] < self.heap[0])
            first = self.heads[0][0] if spilled else self.heap[0] if self.heap else None
            if first is None or first[:2] != (level, node):
                return
            if spilled:
                _, k = heapq.heappop(self.heads)
                self._advance(k)
            else:
                heapq.heappop(self.heap)
            yield first


CARRIED = ("node", "parent", "depth", "conv_id", "n_convs", "ends", "sends")
TOTALS = "node binary, parent binary, depth long, conv_id long, n_convs long, ends long, sends boolean, n_children long, n_leaves long, saved long"


def forwarded(nodes: DataFrame, limit: int = QUEUE) -> DataFrame:
    """TOTALS of ``nodes`` (CARRIED; kids, leaves, saved: what is known already,
    its own share of saved included), each task's nodes sorted by (depth
    descending, node). A node that ``sends`` has its parent in the same task."""

    def process(batches):
        queue = SpillingQueue(limit)
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("node", "parent", "depth", "sends", "kids", "leaves", "saved")]
            children, leaves, saved = [], [], []
            for node, parent, depth, sends, k, n, s in zip(*columns):
                for _, _, more, sum_saved in queue.take(-depth, node):
                    k, n, s = k + 1, n + more, s + sum_saved
                if not k:
                    n = 1
                if sends:
                    queue.push((1 - depth, parent, n, s))
                children.append(k)
                leaves.append(n)
                saved.append(s)
            totals = [pa.array(x, pa.int64()) for x in (children, leaves, saved)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in CARRIED], *totals],
                                             names=[*CARRIED, "n_children", "n_leaves", "saved"])

    return nodes.mapInArrow(process, TOTALS)


def subtree_totals(nodes: DataFrame, paths: DataFrame, least_shard: int = LEAST_SHARD, limit: int = QUEUE) -> DataFrame:
    """TOTALS of the nodes of two members or more."""
    rows = nodes.agg(F.sum("n_convs")).first()[0] or 0
    most = max(least_shard, -(-rows // HEAVY_NODES))
    alone = nodes.where("n_convs = 1 and parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("alone"))
    none = F.lit(0).cast("long")
    shared = nodes.where("n_convs > 1").join(alone, "node", "left").select(
        "node", "parent", "depth", "conv_id", "n_convs", "ends", F.coalesce("alone", none).alias("alone"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("own"))
    shared = materialize(shared, "shared-nodes")
    heavy = shared.where(F.col("n_convs") > most)  # at most HEAVY_NODES
    # A light node lies below the first light node of any member's path.
    first = paths.join(F.broadcast(heavy.select("node")), "node", "left_anti").groupBy("conv_id").agg(
        F.min_by("node", "depth").alias("shard"))
    light = shared.where(F.col("n_convs") <= most).join(first, "conv_id").withColumn("sends", F.col("node") != F.col("shard"))
    light = light.withColumns({"kids": F.col("alone"), "leaves": F.col("alone"), "saved": F.col("own")})
    within = materialize(forwarded(
        light.repartition("shard").sortWithinPartitions(F.desc("depth"), "node"), limit), "shard-totals")
    roots = within.where("not sends").groupBy(F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("more"), F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    top = heavy.join(roots, "node", "left").withColumns({
        "sends": F.col("parent").isNotNull(), "kids": F.col("alone") + F.coalesce("more", none),
        "leaves": F.col("alone") + F.coalesce("more_leaves", none), "saved": F.col("own") + F.coalesce("more_saved", none)})
    across = forwarded(top.repartition(1).sortWithinPartitions(F.desc("depth"), "node"), limit)
    return within.unionByName(across)


# --- the trie ----------------------------------------------------------------------

def ending_hashes(paths: DataFrame) -> DataFrame:
    """(node, ends_sha256) of nodes where conversations end."""
    blocks = paths.where("last").groupBy("node", F.shiftright("conv_id", ENDS_BITS).alias("block")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def digest(batches):
        node, found = None, None
        for batch in batches:
            out = []
            for n, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if n != node:
                    if node is not None:
                        out.append((node, found.hexdigest()))
                    node, found = n, hashlib.sha256(ids.encode())
                else:
                    found.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.binary(), pa.string()))],
                                             names=["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([found.hexdigest()])],
                                             names=["node", "ends_sha256"])

    return blocks.repartition("node").sortWithinPartitions("node", "block").mapInArrow(digest, "node binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, block: int = BLOCK, least_shard: int = LEAST_SHARD, limit: int = QUEUE) -> DataFrame:
    """One row per node: (conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256)."""
    convs, turns = rebuilt(conversations)
    paths = materialize(members(convs, turns, block), "paths")
    nodes = materialize(paths.groupBy("node", "parent", "depth", "chars").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"),
        F.sum(F.col("last").cast("long")).alias("ends")), "nodes")
    totals = materialize(subtree_totals(nodes, paths, least_shard, limit), "totals")
    single = nodes.where("n_convs = 1").select(
        "node", "parent", "depth", "conv_id", "n_convs", (1 - F.col("ends")).alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved"))
    every = totals.select(*single.columns).unionByName(single).join(ending_hashes(paths), "node", "left")
    above = totals.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    return every.join(above, "parent", "left").select(
        "conv_id", "depth",
        # A parent that is not shared has the same only member.
        F.when(F.col("parent").isNotNull(), F.coalesce("above", "conv_id")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
