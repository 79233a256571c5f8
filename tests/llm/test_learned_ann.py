import numpy as np
import pytest
from pyspark.sql import functions as F

from retail_lakehouse.llm import learned_ann, queries
from retail_lakehouse.llm.learned_ann import Fit

SF = "/root/testdata/sf0.01"


def truth(rows, queries_, k):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], dtype=np.float64)
    out = {}
    for q, v in queries_:
        s = (np.array(v, dtype=np.float64) * x).sum(axis=1)
        order = sorted((i for i in range(len(rows)) if ids[i] != q), key=lambda i: (-s[i], ids[i]))[:k]
        out[q] = [(int(ids[i]), float(s[i])) for i in order]
    return out


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_and_scores(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    found = by_query(queries.op7_learned_ann(spark, SF))
    want = truth(rows, [r for r in rows if r[0] % 20 == 0], 20)
    assert set(found) == set(want)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    x = {i: np.array(v, dtype=np.float64) for i, v in rows}
    for q, near in found.items():
        assert near == sorted(near, key=lambda r: (-r[1], r[0])) and q not in [i for i, _ in near]
        assert all(abs(s - float((x[q] * x[i]).sum())) < 1e-12 for i, s in near)


def test_probing_every_part_is_exact(spark, monkeypatch):
    monkeypatch.setattr(learned_ann, "ROWS_PER_CELL", 30)
    monkeypatch.setattr(learned_ann, "QUERIES_PER_CELL", 7)
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, 8)).astype("float32")
    x[200:280] = x[3]  # one vector very often
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = by_query(learned_ann.search(df, F.col("vec_id") % 10 == 0, 20, Fit(parts=4, target_recall=1.0)))
    want = truth(rows, [r for r in rows if r[0] % 10 == 0], 20)
    assert {q: [i for i, _ in v] for q, v in found.items()} == {q: [i for i, _ in v] for q, v in want.items()}


def test_few_copies_of_one_vector_are_scored():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2, (3000, 3)).astype(np.float64)
    ids = rng.integers(0, 900, 3000)
    ids[:50] = 4  # one id very often
    kept = learned_ann.needed_copies(x, ids, 5)
    assert len(kept) <= 8 * 10
    for own in [*np.unique(ids[kept]), -1]:
        for v in np.unique(x, axis=0):
            best = [sorted(ids[at][(x[at] == v).all(axis=1) & (ids[at] != own)])[:5] for at in (np.arange(3000), kept)]
            assert best[0] == best[1]


def test_queries_of_sparse_parts_get_k_rows(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((300, 4))
    weights = np.zeros((6, 4))
    weights[0, 1:] = [40, 41, 42]  # three parts for what lies along the first axis, the rest in part 0
    x[:, 0] = -np.abs(x[:, 0])
    x[::40, 0] *= -1
    monkeypatch.setattr(learned_ann, "learn", lambda *_: learned_ann.Router(weights, 1))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = by_query(learned_ann.search(df, F.col("vec_id") % 20 == 0, 20))
    assert {q: len(near) for q, near in found.items()} == {q: 20 for q in range(0, 300, 20)}


def test_unusable_vectors_few_rows_and_clashing_names(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (40, None), (60, []), (80, [0.0, 0.0]), (100, [float("nan"), 1.0]), (120, [float("inf"), 1.0]),
            (140, [None, 1.0]), (160, [1.0, 2.0, 3.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (None, [1.0, 1.0]), (20, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as v", "2 as part", "3 as rank")
    found = by_query(learned_ann.search(df, F.col("vec_id") % 20 == 0, 20))
    assert found[0] == [(1, 2.0), (2, 2.0), (20, 0.5), (20, 0.5)]
    assert set(found) == {0, 20} and [i for i, _ in found[20][:6:2]] == [1, 2, 0]


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert learned_ann.search(df, F.col("vec_id") % 20 == 0, 20).count() == 0


@pytest.mark.parametrize("parts", [2, 8, 16])
def test_parts_are_balanced_and_cut_few_edges(parts):
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((parts, 32)) * 3
    x = np.concatenate([c + rng.standard_normal((60, 32)) for c in centres])
    graph = learned_ann.neighbour_graph(x, 8)
    label = learned_ann.balanced_parts(graph, parts)
    sizes = np.bincount(label, minlength=parts)
    assert sizes.max() - sizes.min() <= parts
    assert (label[graph] != label[:, None]).mean() < 0.35


def test_sample_is_the_smallest_hashes_in_any_partitioning(spark):
    rows = spark.range(30_000).selectExpr("id as vec_id", "array(cast(id as double), 1D) as v")
    hot = rows.unionByName(spark.range(10_000).selectExpr("5L as vec_id", "array(cast(id as double), 2D) as v"))
    want = [r[0] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(100).collect()]
    for df in (rows.repartition(3), rows.repartition(60), hot.repartition(40)):
        n = df.count()
        assert [r["vec_id"] for r in learned_ann.sampled(df, n, 100).collect()] == want
