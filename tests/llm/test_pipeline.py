import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from llm_helpers import SF, edge_rows, frame  # noqa: E402
from retail_lakehouse.llm import language_id, mixing, queries  # noqa: E402
from retail_lakehouse.llm.common import materialize  # noqa: E402
from test_mixing import WORD, water_fill  # noqa: E402
from test_near_join import brute as near_brute  # noqa: E402
from test_packing import check_bins, expected_pieces  # noqa: E402

STAGES = dict(corpus_pipeline.STAGES)


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def after(spark, docs, name):
    out = materialize(STAGES[name](spark, docs, SF), name)
    if name != "best_fit_packing":
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
    return out


def test_every_stage_on_what_the_one_before_kept(spark):
    docs = queries.documents(spark, SF)
    known = after(spark, docs, "language_id")
    learned = queries.language_dictionaries(docs)
    wanted = {r["doc_id"] for r in language_id.identify(docs, learned, ["doc_id"]).collect() if not r["rejected"]}
    assert {d for d, _ in rows_of(known)} == wanted and len(wanted) >= 0.98 * docs.count()

    single = after(spark, known, "exact_dedup")
    last = {}
    for d, t in rows_of(known):
        last[t or ""] = max(d, last.get(t or "", d))
    assert sorted(rows_of(single)) == sorted((d, t) for t, d in last.items())

    distinct = after(spark, single, "near_join")
    classes = {d: c for d, c, _ in near_brute(rows_of(single))}
    assert sorted(classes[d] for d, _ in rows_of(distinct)) == sorted(set(classes.values()))
    assert dict(rows_of(distinct)).items() <= dict(rows_of(single)).items()

    mixed = after(spark, distinct, "source_mix")
    taken = {r["doc_id"]: r["taken"] for r in mixing.taken_words(distinct, queries.MIX).collect()}
    assert {d: len(WORD.findall(t)) for d, t in rows_of(mixed)} == {d: n for d, n in taken.items() if n}
    words = {d: set(WORD.findall(t or "")) for d, t in rows_of(distinct)}
    assert all(set(WORD.findall(t)) <= words[d] for d, t in rows_of(mixed))
    sizes = {}
    for r in distinct.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(WORD.findall(r["text"] or ""))
    goal = dict(zip(sorted(sizes), water_fill([sizes[s] for s in sorted(sizes)], (3, 1, 2))))
    for r in mixed.groupBy("source").agg({"n_chars": "sum"}).collect():
        total = sum(len(WORD.findall(m["text"])) for m in mixed.where(mixed.source == r["source"]).collect())
        assert abs(total - goal[r["source"]]) <= queries.MIX.block_words
        break

    packed = after(spark, mixed, "best_fit_packing").collect()
    assert sorted([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed], key=str) == expected_pieces(rows_of(mixed), 2048)
    check_bins(packed, queries.SEQUENCE)


def test_run_is_the_stages_in_order(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_join", "source_mix", "best_fit_packing"]
    docs = queries.documents(spark, SF)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, corpus_pipeline.run(spark, SF).collect())) == sorted(map(key, docs.collect()))


@pytest.mark.parametrize("rows", [edge_rows(), []], ids=["edges", "empty"])
def test_odd_rows_pass_through_every_stage(spark, rows):
    docs = frame(spark, rows)
    for name, _ in corpus_pipeline.STAGES:
        docs = after(spark, docs, name)
    assert rows or docs.count() == 0


def test_stages_delete_their_own_tables_only(spark, monkeypatch):
    """A table that another query writes while a stage runs survives; a stage that fails leaves none."""
    from concurrent.futures import ThreadPoolExecutor

    from retail_lakehouse.session import materialized

    docs = materialize(frame(spark, edge_rows()), "input")
    inner = corpus_pipeline.exact_dedup.deduplicated
    others = []

    def meanwhile(*a, **k):
        with ThreadPoolExecutor(1) as pool:
            others.append(pool.submit(lambda: materialize(spark.range(5).toDF("n"), "other-query")).result())
        return inner(*a, **k)

    monkeypatch.setattr(corpus_pipeline.exact_dedup, "deduplicated", meanwhile)
    earlier = set(materialized())
    first = materialize(STAGES["exact_dedup"](spark, docs, SF), "first")
    left = [t for t in materialized() if "recipes" in t and t not in earlier]
    second = materialize(STAGES["near_join"](spark, first, SF), "second")
    assert left and not set(left) & set(materialized())
    assert others[0].count() == 5 and docs.count() == len(edge_rows()) and second.count() > 0

    before = set(materialized())
    monkeypatch.setattr(corpus_pipeline.exact_dedup, "deduplicated", lambda d, **k: (materialize(d, "half"), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        STAGES["exact_dedup"](spark, docs, SF)
    assert not set(materialized()) - before and corpus_pipeline._BEFORE.get() == ()
