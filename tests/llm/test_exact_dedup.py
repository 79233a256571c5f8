import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from llm_helpers import SF, edge_rows, frame
from retail_lakehouse.llm import exact_dedup, queries


def brute(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[text or ""].append(doc)
    key = lambda d: (d is not None, d or 0)
    return sorted(((doc, max(groups[t or ""], key=key), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for doc, t in rows), key=str)


def check(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = exact_dedup.exact_copies(docs).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found), key=str) == brute(rows)
    assert sum(r["kept"] for r in found) == len({t or "" for _, t in rows})
    assert all(r["doc_id"] == r["keep_id"] for r in found if r["kept"])


def test_edge_rows(spark):
    docs = frame(spark, edge_rows()).selectExpr("*", "1 as keep_id", "2 as best", "3 as recipe")
    check(spark, docs)
    kept = exact_dedup.deduplicated(docs)
    assert kept.columns == docs.columns and kept.count() == len({t or "" for _, t, *_ in edge_rows()})


def test_documents(spark):
    check(spark, queries.documents(spark, SF))


def test_empty_table(spark):
    assert exact_dedup.exact_copies(frame(spark, [])).count() == 0


def test_chunks_are_the_text_and_survive_insertions(spark):
    docs = queries.documents(spark, SF).where("length(text) > 8000").limit(5)
    c = docs.select("text", exact_dedup.chunks(F.col("text")).alias("a"),
                    exact_dedup.chunks(F.concat(F.lit("New words at the start. "), "text")).alias("b")).collect()
    assert c
    for r in c:
        assert "".join(r["a"]) == r["text"] and max(map(len, r["a"])) <= 4096
        assert len(set(r["a"]) & set(r["b"])) >= len(r["a"]) - 8


def test_colliding_identifiers_are_noticed(spark, monkeypatch):
    docs = frame(spark, edge_rows())
    real = exact_dedup.chunk_id
    monkeypatch.setattr(exact_dedup, "chunk_id", lambda c, seed: real(c, seed) if seed else F.struct(F.lit(0).alias("a"), F.lit(0).alias("b")))
    assert exact_dedup.verified_seed(docs) == 1
    check(spark, docs)


def test_no_python_in_the_plan(spark):
    plan = exact_dedup.exact_copies(queries.documents(spark, SF))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
