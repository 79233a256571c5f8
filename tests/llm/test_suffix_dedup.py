import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from llm_helpers import SF, edge_rows, frame
from retail_lakehouse.llm import queries, suffix_dedup


def brute(rows, n=400):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i:i + n] for _, b in texts for i in range(len(b) - n + 1))
    out = []
    for d, b in texts:
        cover = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if seen[b[i:i + n]] > 1:
                cover[i:i + n] = b"\1" * n
        spans = sum(1 for i, c in enumerate(cover) if c and not (i and cover[i - 1]))
        out.append((d, len(b), sum(cover), spans, hashlib.sha256(bytes(x for x, c in zip(b, cover) if not c)).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()), key=str)


def passages(seed=4):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghié ") for _ in range(rng.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    p = [text(k) for k in (80, 90, 150, 400)]
    out = []
    for i in range(40):
        parts = [text(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            q = rng.choice(p)
            a = rng.randint(0, 40)
            parts += [q[a:len(q) - rng.randint(0, 40)], text(rng.randint(0, 30))]
        out.append("".join(parts))
    out += ["x" * 1500, "ab" * 500, "abc" * 300, "line of some words\n" * 60, p[3], p[3] + "!", p[0][:399], p[0][:400], p[0]]
    return out


def test_passages_and_periods(spark):
    rows = list(enumerate(passages()))
    docs = frame(spark, [(i, t, "en", "s", 0) for i, t in rows])
    assert got(suffix_dedup.cleaned(docs)) == brute(rows)


@pytest.mark.parametrize("group,unit,windows", [(3, 4_000_000, 400_000), (4000, 700, 400_000), (4000, 4_000_000, 200)])
def test_split_groups_long_texts_and_small_lots(spark, monkeypatch, group, unit, windows):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    monkeypatch.setattr(suffix_dedup, "UNIT", unit)
    monkeypatch.setattr(suffix_dedup, "WINDOWS", windows)
    rows = list(enumerate(passages(7)))
    docs = frame(spark, [(i, t, "en", "s", 0) for i, t in rows])
    assert got(suffix_dedup.cleaned(docs)) == brute(rows)


def test_a_passage_in_most_texts_leaves_only_bounded_groups(spark, monkeypatch):
    """Pieces that begin and end with a text's own bytes must not meet in one task as a whole."""
    monkeypatch.setattr(suffix_dedup, "GROUP", 3)
    monkeypatch.setattr(suffix_dedup, "LOT_BYTES", 4000, raising=False)
    seen, real = [], suffix_dedup.compared

    def watched(cuts):
        seen.append(cuts.groupBy("key", "part", "core").agg({"data": "count"}).agg({"count(data)": "max"}).first()[0])
        return real(cuts)

    monkeypatch.setattr(suffix_dedup, "compared", watched)
    rng = random.Random(5)
    own = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = own(700)
    rows = [(i, own(300 + i) + passage[i % 2 * 3:] + own(200)) for i in range(60)] + list(enumerate(passages(8), 60))
    docs = frame(spark, [(i, t, "en", "s", 0) for i, t in rows])
    assert got(suffix_dedup.cleaned(docs)) == brute(rows)
    assert max(seen) <= 10  # parts of 400 bytes and more


def test_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in queries.documents(spark, SF).collect()]
    assert got(queries.op8_suffix_dedup(spark, SF)) == brute(rows)


def test_edge_rows(spark):
    rows = [r[:2] for r in edge_rows()]
    docs = frame(spark, edge_rows()).selectExpr("*", "1 as k1", "2 as spans", "3 as key")
    assert got(suffix_dedup.cleaned(docs)) == brute(rows)
    for r in suffix_dedup.cleaned(docs, keep_bytes=True).collect():
        assert hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"]
        assert sum(s["to"] - s["from"] for s in r["spans"]) == r["n_removed"] and len(r["spans"]) == r["n_spans"]


def test_empty_table(spark):
    assert suffix_dedup.cleaned(frame(spark, [])).count() == 0


def test_suffix_order_is_the_byte_order():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 100, 3000).astype(np.uint8)
    starts = rng.choice(2900, 500, replace=True)
    group = rng.integers(0, 7, 500)
    order, shared = suffix_dedup.suffix_order(data, suffix_dedup.PrefixHash(data, suffix_dedup.BASES[0]), starts, group, 100)
    keys = [(group[i], bytes(data[starts[i]:starts[i] + 100])) for i in order]
    assert keys == sorted(keys) and sorted(order.tolist()) == list(range(500))
    for k in range(1, 500):
        if keys[k][0] == keys[k - 1][0]:
            a, b = keys[k][1], keys[k - 1][1]
            assert shared[k] == next((i for i in range(100) if a[i] != b[i]), 100)


def test_hash_collisions_are_verified_away(monkeypatch):
    """A base under which stretches collide must not give wrong windows."""
    data = np.frombuffer(b"a" * 399 + b"b" + b"a" * 398 + b"bb", dtype=np.uint8)
    real = suffix_dedup.PrefixHash

    class Weak(real):
        def __init__(self, data, base):
            super().__init__(data, base)
            self.weak = base == suffix_dedup.BASES[0]

        def stretch(self, at, n):
            h = super().stretch(at, n)
            return h & np.uint64(0) if self.weak else h

    monkeypatch.setattr(suffix_dedup, "PrefixHash", Weak)
    assert suffix_dedup.repeated_windows(data, np.array([0, 400]), np.zeros(2, np.int64)).tolist() == [False, False]
