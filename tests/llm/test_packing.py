import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from retail_lakehouse.llm import packing, queries
from retail_lakehouse.llm.packing import Capacity
from llm_helpers import SF, edge_rows, frame

PATH = queries.tokenizer_path(queries.BYTE_BPE)


def expected_pieces(rows, size, end=0):
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    out = []
    for doc, text in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, end]
        first = len(ids) % size or size
        for k, (b, e) in enumerate(zip([0, *range(first, len(ids), size)], [*range(first, len(ids) + 1, size)])):
            out.append((doc, k, b, e - b, zlib.crc32(np.array(ids[b:e], dtype="<u4").tobytes())))
    return sorted(out, key=str)


def check_bins(rows, capacity):
    """Every sequence is gapless and within every capacity; returns their number."""
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for items in bins.values():
        items.sort()
        assert items[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(items, items[1:]))
        assert sum(n for _, n in items) <= capacity.tokens and len(items) <= capacity.documents
        assert sum(n * n for _, n in items) <= capacity.attention
    return len(bins)


def test_edge_rows(spark):
    cap = Capacity(64, 64, 64 * 64)
    rows = edge_rows()
    docs = frame(spark, rows).selectExpr("*", "1 as length", "'x' as piece")
    got = packing.pack_documents(docs, PATH, cap).collect()
    assert sorted([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got], key=str) == expected_pieces([r[:2] for r in rows], 64)
    n = check_bins(got, cap)
    assert n <= -(-sum(r["length"] for r in got) // 64) + 1


def test_documents(spark):
    docs = queries.documents(spark, SF)
    got = queries.op1_best_fit_packing(spark, SF).collect()
    want = expected_pieces([(r["doc_id"], r["text"]) for r in docs.collect()], 2048)
    assert sorted([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got], key=str) == want
    n = check_bins(got, queries.SEQUENCE)
    assert n <= -(-sum(r["length"] for r in got) // 2048) + 1


def test_empty_table(spark):
    assert packing.pack_documents(frame(spark, []), PATH, Capacity(8, 8, 64)).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_all_constraints_hold(rule):
    rng = np.random.default_rng(3)
    for cap in (Capacity(100, 4, 10_000), Capacity(100, 100, 2_600), Capacity(100, 3, 4_000)):
        hist = {int(k): int(v) for k, v in zip(rng.choice(np.arange(1, 51), 20, replace=False), rng.integers(1, 40, 20))}
        plan = packing.plan_bins(hist, cap, rule, packing.average_demand_weights(hist, cap))
        placed = defaultdict(int)
        for what, count in plan:
            assert sum(n * k for n, k in what) <= cap.tokens
            assert sum(k for _, k in what) <= cap.documents
            assert sum(n * n * k for n, k in what) <= cap.attention
            for n, k in what:
                placed[n] += k * count
        assert placed == hist


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_histogram_plan_is_item_by_item_best_fit(rule):
    rng = np.random.default_rng(5)
    for _ in range(30):
        cap = Capacity(60, int(rng.integers(2, 8)), int(rng.integers(1600, 3600)))
        hist = {int(k): int(v) for k, v in zip(rng.choice(np.arange(1, 41), 8, replace=False), rng.integers(1, 12, 8))}
        weights, caps = np.array([0.7, 0.1, 0.2]), cap.vector()
        bins = []
        for length in sorted(hist, reverse=True):
            need = packing.demand(length)
            for _ in range(hist[length]):
                fits = [b for b in bins if (b >= need).all()]
                if not fits:
                    bins.append(caps - need)
                    continue
                score = (lambda b: (((b - need) / caps) ** 2 * weights).sum()) if rule == "norm" else (
                    lambda b: -((b / caps) * (need / caps) * weights).sum())
                best = min(fits, key=score)
                best -= need
        plan = packing.plan_bins(hist, cap, rule, weights)
        assert sum(c for _, c in plan) == len(bins)


def test_ids_are_kept(spark):
    got = packing.pack_documents(frame(spark, edge_rows()[:4]), PATH, Capacity(4, 4, 16), keep_ids=True).collect()
    for r in got:
        assert len(r["ids"]) == r["length"]
        assert zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) == r["ids_crc32"]
