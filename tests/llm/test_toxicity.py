import random
import zlib

import numpy as np
import pytest

from llm_helpers import edge_rows, frame
from retail_lakehouse.llm import queries, toxicity as tx

SF, SMALL = "/root/testdata/sf0.1", "/root/testdata/sf0.001"


def marked(spark):
    return queries.documents(spark, SF).selectExpr("*", "crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0 as training")


@pytest.fixture(scope="module")
def network(spark):
    return tx.learn(marked(spark), spark.read.parquet(f"{SF}/labels.parquet"), "training")


def test_held_out_accuracy(spark, network):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    found = tx.scored(marked(spark).where("not training"), network, ["doc_id"]).collect()
    held = [(labels[r["doc_id"]], r["predicted"]) for r in found if r["doc_id"] in labels]
    toxic, clean = [p for y, p in held if y], [p for y, p in held if not y]
    assert len(toxic) > 50 and sum(toxic) >= 0.6 * len(toxic) and sum(clean) <= 0.03 * len(clean)


def test_query(spark):
    found = queries.op12_toxicity(spark, SMALL).collect()
    assert len(found) == queries.documents(spark, SMALL).count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)


def test_score_needs_the_text_only(spark, network):
    docs = queries.documents(spark, SF).where("doc_id < 50")
    a = tx.scored(docs, network, ["doc_id"]).collect()
    b = tx.scored(docs.selectExpr("doc_id", "text", "'zz' as lang"), network, ["doc_id"]).collect()
    assert a == b


def test_long_texts_are_scored_whole(spark, network):
    """One hidden word anywhere in a long clean text decides, and slices and lots change nothing."""
    clean = [r["text"] for r in queries.documents(spark, SF).where("doc_id = 1").collect()][0]
    words = (clean + " ") * 20
    at = [0, len(words) // 2, len(words)]
    texts = [words] + [words[:k].rsplit(" ", 1)[0] + " worthless scum idiot " + words[k:] for k in at]
    score = tx.Scorer(network).scores(texts)
    assert score[0] < 0.5 and (score[1:] > 0.5).all()
    one_by_one = [tx.Scorer(network).scores([t])[0] for t in texts]
    assert np.allclose(score, one_by_one, atol=1e-5)


def test_windows_overlap_and_cover():
    for n in (0, 1, 31, 32, 33, 56, 57, 500):
        starts = tx.windows_of(n)
        covered = {k for s in starts for k in range(s, min(n, s + tx.WINDOW))}
        assert covered == set(range(n)) and all(s == 0 or s < n for s in starts)


def plain_score(p, words):
    """The network word by word, straight from its equations."""
    def sig(x):
        return 1 / (1 + np.exp(-x))

    h = tx.HIDDEN
    inputs = []
    for w in words:
        ids, grams, count = tx.features([w])
        chars = sum(p["grams"][g] for g in grams) / np.sqrt(count[0])
        inputs.append(np.concatenate([p["words"][ids[0]], chars]) @ p["w"] + p["b"])

    def run(xs, u):
        state, out = np.zeros(h), []
        for x in xs:
            g = state @ u
            r, z = sig(x[:h] + g[:h]), sig(x[h:2 * h] + g[h:2 * h])
            new = np.tanh(x[2 * h:] + r * g[2 * h:])
            state = (1 - z) * new + z * state
            out.append(state)
        return out

    f = run([x[:3 * h] for x in inputs], p["uf"])
    b = run([x[3 * h:] for x in reversed(inputs)], p["ub"])[::-1]
    states = [np.concatenate(s) for s in zip(f, b)]
    if not states:
        return p["bo"][0]
    energy = np.array([np.tanh(s @ p["wa"] + p["ba"]) @ p["va"] for s in states])
    share = np.exp(energy - energy.max()) / np.exp(energy - energy.max()).sum()
    return sum(a * s for a, s in zip(share, states)) @ p["wo"] + p["bo"][0]


def test_equals_the_equations():
    rng = np.random.default_rng(5)
    p = tx.new_parameters(rng)
    r = random.Random(5)
    texts = [" ".join(r.choices(["aa", "bcd", "éf", "ghijk", "x1"], k=k)) for k in (0, 1, 5, 32, 33, 100)]
    got = tx.Scorer(tx.Network(p)).scores(texts)
    for text, score in zip(texts, got):
        words = text.split()
        best = max(plain_score(p, words[s:s + tx.WINDOW]) for s in tx.windows_of(len(words)))
        assert score == pytest.approx(1 / (1 + np.exp(-best)), abs=1e-5)


def test_gradients():
    rng = np.random.default_rng(6)
    p = {k: v.astype(np.float64) for k, v in tx.new_parameters(rng).items() if k not in ("words", "grams")}
    x = rng.standard_normal((4, 3, 6 * tx.HIDDEN))
    length, labels = np.array([4, 2, 1]), np.array([1.0, 0.0, 1.0])

    def loss():
        out = tx.logits(p, x, length).astype(np.float64)
        return np.mean(np.log1p(np.exp(out)) - labels * out)

    dx, grad = tx.gradients(p, x, length, labels)
    for name, table, g in [("x", x, dx)] + [(k, p[k], grad[k]) for k in ("uf", "ub", "wa", "ba", "va", "wo", "bo")]:
        for flat in rng.choice(table.size, min(4, table.size), replace=False):
            i = np.unravel_index(flat, table.shape)
            old, ends = table[i], []
            for step in (1e-2, -1e-2):
                table[i] = old + step
                ends.append(loss())
            table[i] = old
            assert (ends[0] - ends[1]) / 2e-2 == pytest.approx(g[i], abs=2e-4), name


def test_edge_rows_and_nothing_to_learn(spark, network):
    docs = frame(spark, edge_rows()).selectExpr("*", "1 as score", "2 as predicted", "'x' as text__", "'y' as chosen", "3 as toxic")
    found = tx.scored(docs, network, docs.columns).collect()
    assert [r["text"] for r in found] == [r[1] for r in edge_rows()]
    empty = {r["score"] for r in found if r["doc_id"] in (3, 4, 6)}
    assert len(empty) == 1 and max(empty) < 0.5 and all(0 <= r["score"] <= 1 for r in found)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (None, 0), (7, None)], "doc_id long, toxic int")
    one_sided = tx.learn(docs, labels, docs["n_chars"] >= 0)
    assert one_sided.p is None and one_sided.prior == 1.0
    none = tx.learn(frame(spark, []), labels, "n_chars is not null")
    assert none.p is None and none.prior == 0.0
    assert tx.scored(frame(spark, []), network, ["doc_id"]).count() == 0
    assert {r["score"] for r in tx.scored(docs, none, ["doc_id"]).collect()} == {0.0}


def test_learning_from_hashed_sample_only(spark, monkeypatch):
    docs = frame(spark, [(i, f"word{i} {'bad' if i % 2 else 'good'} thing", "en", "s", 1) for i in range(400)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(tx, "train", lambda sample: seen.append(sample) or None)
    tx.learn(docs, labels, "n_chars = 1", sample={0: 50, 1: 50})
    assert 60 <= len(seen[0].labels) <= 150 and 0.3 < seen[0].labels.mean() < 0.7
