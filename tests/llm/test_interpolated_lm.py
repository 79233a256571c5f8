import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import SF, edge_rows, frame
from retail_lakehouse.llm import interpolated_lm as lm
from retail_lakehouse.llm import queries

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def words(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def brute(rows, trains, weights=None):
    """Per row (n_tokens, n_known, N, base score, model score), the weights of the buckets being given."""
    uni, pair, texts = Counter(), Counter(), 0
    for (_, text), train in zip(rows, trains):
        if train:
            w = words(text)
            uni.update(w)
            pair.update(zip(["<s>", *w], w))
            texts += 1
    n, v = sum(uni.values()), len(uni)
    out = []
    for _, text in rows:
        w = words(text)
        base = sum(math.log10((uni[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        model = 0.0
        for h, x in zip(["<s>", *w], w):
            c = texts if h == "<s>" else uni[h]
            bucket = 0 if not c else int(math.floor(math.log2(c))) + 1
            l2, l1, l0 = weights(bucket)
            if not c:
                l2, l1, l0 = 0, l1 / (l1 + l0), l0 / (l1 + l0)
            model += math.log10(l2 * pair[h, x] / max(c, 1) + l1 * uni[x] / max(n, 1) + l0 / (v + 1)) if n else 0
        out.append((len(w), sum(uni[x] > 0 for x in w), n, base, model))
    return out


def check(spark, rows, fold, monkeypatch):
    kept = {}
    real = lm.scored

    def spy(table, weights, *rest):
        kept["weights"] = weights
        return real(table, weights, *rest)

    monkeypatch.setattr(lm, "scored", spy)
    docs = frame(spark, [(*r, "en", "s", 0) for r in rows]).selectExpr("*", "true as train", "1 as n_tokens")
    found = lm.score_texts(docs, fold).collect()

    def weights(bucket):
        while bucket >= 0 and bucket not in kept["weights"]:
            bucket -= 1
        return kept["weights"].get(bucket, [1 / 3] * 3)

    trains = [r["t"] for r in frame(spark, [(*r, "en", "s", 0) for r in rows]).select(fold.alias("t")).collect()]
    want = sorted(((d, not t, *b) for (d, _), t, b in zip(rows, trains, brute(rows, trains, weights))), key=str)
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in found), key=str)
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=lambda r: (str(r[0]), r[2], r[5])), sorted(want, key=lambda r: (str(r[0]), r[2], r[5]))):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9)
    return kept["weights"]


def test_edge_rows(spark, monkeypatch):
    rows = [r[:2] for r in edge_rows()]
    check(spark, rows, F.coalesce(F.col("doc_id"), F.lit(0)) % 3 != 1, monkeypatch)


def test_small_blocks_meet(spark, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 40)
    rows = [(i, "the cat sat on the mat " * (i % 4) + f"word{i % 7} End") for i in range(60)]
    check(spark, rows, F.col("doc_id") % 5 != 1, monkeypatch)


def test_documents(spark, monkeypatch):
    docs = [(r["doc_id"], r["text"]) for r in queries.documents(spark, SF).collect()]
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1
    check(spark, docs, fold, monkeypatch)
    found = queries.op2_interpolated_lm(spark, SF).collect()
    assert {r["doc_id"]: r["held_out"] for r in found} == {d: zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in docs}
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > 1.05 * sum(r["base_score"] for r in held)  # logs: nearer to 0 is better


def test_no_training_texts_and_empty_table(spark):
    docs = frame(spark, edge_rows())
    assert {(r["score"], r["train_tokens"]) for r in lm.score_texts(docs, F.lit(False)).collect()} == {(0.0, 0)}
    assert lm.score_texts(frame(spark, []), F.lit(True)).count() == 0


def test_weights_follow_the_held_out_counts():
    often = [(5, lm.BINS * -1, 80, 900), (5, lm.NONE, 80, 100)]
    rarely = [(1, lm.BINS * -1, 80, 100), (1, lm.NONE, 80, 900), (1, lm.NONE, lm.NONE, 50)]
    w = lm.learn_weights(often + rarely, 10 ** 6, 10 ** 4)
    assert w[5][0] > 0.8 and w[1][0] < 0.2 and w[1][2] > w[5][2]
    assert all(np.isclose(x.sum(), 1) and (x > 0).all() for x in w.values())


def test_the_model_is_a_distribution(spark):
    """Over all words that can follow, and the unknown one, probabilities sum to 1."""
    rows = [(1, "a b a b c"), (2, "b a"), (3, "c c a")]
    vocab = ["a", "b", "c", "zzz"]
    docs = frame(spark, [(*r, "en", "s", 0) for r in rows])
    asked = [(100 + i, w) for i, w in enumerate(vocab)] + [(200, "")]
    both = docs.union(frame(spark, [(*r, "en", "s", 0) for r in asked]))
    found = {r["doc_id"]: 10 ** r["score"] for r in lm.score_texts(both, F.col("doc_id") < 100).collect()}
    after_start = {w: found[100 + i] for i, w in enumerate(vocab)}
    # P(w) P(end | w): divide by the end's share, which a text of two of them gives.
    assert 0 < sum(after_start.values()) + found[200] < 1.0
