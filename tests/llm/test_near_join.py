import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_helpers import SF, edge_rows, frame
from retail_lakehouse.llm import components as module
from retail_lakehouse.llm import near_join, queries
from retail_lakehouse.llm.common import materialize, numbered
from retail_lakehouse.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(text or "")
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * n
    by_size = {}
    for i in range(n):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or (a and b and min(len(a), len(b)) >= threshold * max(len(a), len(b)) and len(a & b) >= threshold * len(a | b)):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    del by_size
    low = {}
    for i in range(n):
        low.setdefault(find(i), []).append(rows[i][0])
    least = {r: min((x for x in ids if x is not None), default=None) for r, ids in low.items()}
    return sorted(((rows[i][0], least[find(i)], links[i]) for i in range(n)), key=str)


def got(df):
    return sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in df.collect()), key=str)


def test_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in queries.documents(spark, SF).collect()]
    assert got(queries.op6_near_join(spark, SF)) == brute(rows)


def variants(n, words=120, edits=4, seed=0):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(words)] = f"e{rng.randrange(10 ** 9)}"
        out.append(" ".join(w))
    return out


def test_large_group_of_near_copies_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_join, "BLOCK", 16)
    monkeypatch.setattr(near_join, "SUB_BUCKET", 25)
    texts = variants(150) + variants(10, seed=9) + ["one two three", "one two three", "four five"] + [f"alone {i} a b c d e f" for i in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = frame(spark, [(i, t, "en", "s", len(t)) for i, t in rows])
    assert got(near_join.near_copies(numbered(docs)[0])) == brute(rows)


@pytest.mark.parametrize("sub_bucket,block", [(20_000, 4096), (7, 5)])
def test_pairs_that_meet_in_one_crowded_bucket_only(spark, monkeypatch, sub_bucket, block):
    """As if a passage shared by all texts had made the one bucket in which they meet."""
    real = near_join.sketches

    def crowded(docs, depth):
        alone = F.transform("prefix", lambda p, i: F.when(i == 0, F.lit(7)).otherwise(F.xxhash64("row__", i)))
        far = F.transform("rest", lambda r: F.xxhash64("row__"))
        return real(docs, depth).withColumn("prefix", alone).withColumn("rest", far)

    monkeypatch.setattr(near_join, "sketches", crowded)
    monkeypatch.setattr(near_join, "SUB_BUCKET", sub_bucket)
    monkeypatch.setattr(near_join, "SIGNATURES", block, raising=False)
    rng = random.Random(3)
    texts = [f"alone {i} " + " ".join(f"w{rng.randrange(5000)}" for _ in range(100)) for i in range(30)]
    for seed in range(8):
        texts += variants(1 + seed % 4, edits=2, seed=seed)
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = frame(spark, [(i, t, "en", "s", len(t)) for i, t in rows])
    assert got(near_join.near_copies(numbered(docs)[0])) == brute(rows)


def test_edge_rows(spark):
    rows = [r for r in edge_rows()]
    docs = frame(spark, rows).selectExpr("*", "1 as class_id", "2 as prefix")
    want = brute([r[:2] for r in rows])
    found = near_join.near_copies(numbered(docs.select("doc_id", "text"))[0])
    assert got(found) == want
    kept = near_join.without_near_copies(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({r["class_row__"] for r in found.collect()})


def test_empty_table(spark):
    assert near_join.near_copies(numbered(frame(spark, []))[0]).count() == 0


def test_shingle_sets_match_the_definition():
    texts = ["a b c d e f", "a b c d e f a b c d e f", "", None, "x", " \t", "a b", "b a", "a b c d e"]
    x, n = near_join.shingle_sets(pa.array([t or "" for t in texts]))
    assert n.tolist() == [len(shingles(t)) for t in texts]
    ends = np.concatenate([[0], np.cumsum(n)])
    own = [set(x[a:b].tolist()) for a, b in zip(ends, ends[1:])]
    assert own[0] < own[1] and own[6] != own[7] and own[8] < own[0]


@pytest.mark.parametrize("threshold,recall", [(0.8, 0.9995), (0.8, 0.95), (0.9, 0.999)])
def test_depth_reaches_the_recall(threshold, recall):
    d = near_join.shortened_depth(threshold, recall)
    assert 1 - (1 - threshold ** d) ** near_join.TREES >= recall
    assert d == near_join.DEPTH or 1 - (1 - threshold ** (d + 1)) ** near_join.TREES < recall


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    found = {r["vertex"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}


def test_components_stop_at_stars(spark, monkeypatch):
    written = []
    monkeypatch.setattr(module, "materialize", lambda df, label: written.append(materialize(df, label)) or written[-1])
    stars = spark.createDataFrame([(1, v) for v in range(2, 60)] + [(100, v) for v in range(101, 120)] + [(7, 7)], "a long, b long")
    found = {(r["vertex"], r["root"]) for r in components(stars).collect()}
    assert found == {(v, 1) for v in range(1, 60)} | {(v, 100) for v in range(100, 120)}
    assert not written
    # Two stars that share leaves: one round, the edges of it in a task per core, not one per shuffle partition.
    edges = [(1, v) for v in range(3, 40)] + [(2, v) for v in range(3, 40)]
    shared = spark.createDataFrame(edges + edges[:5], "a long, b long")
    monkeypatch.setattr(module, "EDGES", 10 ** 6)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "31")
    try:
        assert {(r["vertex"], r["root"]) for r in components(shared).collect()} == {(v, 1) for v in range(1, 40)}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[0])
        spark.conf.set("spark.sql.shuffle.partitions", before[1])
    assert len(written) == 2
    assert all(len(t.inputFiles()) <= spark.sparkContext.defaultParallelism for t in written)


def test_components_of_chains_and_repeated_edges(spark):
    edges = [(v, v + 1) for v in range(200)] + [(300 - v, 299 - v) for v in range(50)] + [(0, 1)] * 3 + [(500, 500)]
    found = {r["vertex"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {v: 0 for v in range(201)} | {v: 250 for v in range(250, 301)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
