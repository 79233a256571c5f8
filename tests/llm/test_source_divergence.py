import random
import re
from collections import Counter

import numpy as np

from llm_helpers import edge_rows, frame
from retail_lakehouse.llm import source_divergence as sd

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {i: i + 32 for i in range(65, 91)}


def brute_force(rows, min_documents, top):
    """Straight from the definition, in Python integers."""
    docs, counts, groups = Counter(), Counter(), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall((text or "").translate(UPPER))
        docs.update((lang, t) for t in set(terms))
        counts.update((lang, source, t) for t in terms)
    out = set()
    for lang in {g[0] for g in groups}:
        sources = sorted(s for g, s in groups if g == lang)
        kept = sorted(t for (g, t), n in docs.items() if g == lang and n >= min_documents)

        def p(source_list):
            n = {t: sum(counts[lang, s, t] for s in source_list) for t in kept}
            total = sum(n.values()) + 5 * len(kept)
            return {t: 1 + 10 ** 9 * (n[t] + 5) // total for t in kept}

        each, q = {s: p([s]) for s in sources}, p(sources)
        for s in sources:
            pairs = [(sum(abs(each[s][t] - each[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(each[s][t] - q[t], t) for t in kept if counts[lang, s, t] and each[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, v, k) for k, (v, item) in enumerate(found[:most], 1)}
    return out


def random_rows(n, seed):
    r = random.Random(seed)
    words = ["Alpha", "beta", "é", "ÀB", "x1y", "gamma-delta", "ZETA", "zeta", "漢字", "a", "b'c"]
    return [(i, " ".join(r.choices(words, k=r.randint(0, 12))), r.choice(["en", "de", None, ""]),
             r.choice(["a", "b", "c", None]), 0) for i in range(n)]


def found(spark, rows, **kw):
    df = sd.divergences(frame(spark, rows), **kw)
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    got = [tuple(r) for r in df.collect()]
    assert len(set(got)) == len(got)
    return set(got)


def test_equals_brute_force(spark):
    rows = random_rows(400, 1)
    assert found(spark, rows, min_documents=30, top=3) == brute_force(rows, 30, 3)


def test_spills_slices_and_ties(spark):
    rows = random_rows(150, 2) + random_rows(150, 2)  # repeated rows are documents of their own
    # A spill after nearly every document, slices of about two terms.
    assert found(spark, rows, min_documents=2, top=2, spill_entries=3, slice_terms=2) == brute_force(rows, 2, 2)


def test_edge_rows(spark):
    rows = edge_rows()
    for least in (1, 3, 1000):  # 1000: no term is kept, pairs have value 0
        assert found(spark, rows, min_documents=least, top=50) == brute_force(rows, least, 50)
    assert found(spark, []) == set()


def test_extra_columns_with_clashing_names(spark):
    rows = random_rows(60, 3)
    docs = frame(spark, rows).selectExpr("*", "'q' as term", "1 as n", "2 as v", "3 as slice", "'z' as part", "5 as value", "6 as rank", "7 as sources")
    got = {tuple(r) for r in sd.divergences(docs, min_documents=2).collect()}
    assert got == brute_force(rows, 2, 50)


def test_long_texts_are_read_piece_by_piece(monkeypatch):
    text = "Uno dos-DOS trés " * 500 + "x" * 300 + " end"
    whole = sd.term_counts(text)
    monkeypatch.setattr(sd, "_PIECE", 40)
    assert sd.term_counts(text) == whole == Counter(t.encode() for t in TERM.findall(text.translate(UPPER)))


def test_division_is_exact():
    r = random.Random(4)
    for _ in range(300):
        total, terms = r.randrange(10 ** 15), r.randrange(1, 10 ** 6)
        n = r.randint(0, total)
        got = sd.scaled(np.array([n]), np.array([total]), terms)[0]
        assert int(got) == 1 + 10 ** 9 * (n + 5) // (total + 5 * terms)
    assert int(sd.scaled(np.array([7]), np.array([7]), 1)[0]) == 10 ** 9 + 1
