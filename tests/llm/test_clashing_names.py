"""Input columns named like the operators' own helpers change nothing, and stages keep them."""

import pytest

import corpus_pipeline
from llm_helpers import SF, edge_rows, frame
from retail_lakehouse.llm import exact_dedup, interpolated_lm, language_id, mixing, near_join, packing, prefix_trie, queries
from retail_lakehouse.llm import source_divergence, suffix_dedup, toxicity
from retail_lakehouse.llm.common import free_name, located, materialize, numbered
from pyspark.sql import functions as F

NAMES = ["row__", "ROW___", "salt__", "rank__", "bucket__", "name__", "train__", "text__", "segments__", "first__", "words__", "uses__",
         "key", "list", "spans", "id", "size", "begin", "block", "seed", "chunk", "recipe", "best", "kept", "group_size", "weight",
         "class_id", "class_row__", "copy_id", "n_links", "length", "piece", "start", "n", "sid", "held_out", "chosen", "order"]


def cluttered(docs):
    return docs.select("*", *[F.lit(7).alias(n) for n in NAMES])


def rows(df, columns=None):
    return sorted(map(tuple, (df.select(*columns) if columns else df).collect()), key=str)


def small(spark):
    return frame(spark, edge_rows() + [(50 + i, f"one two three four five six seven {i // 2}", "en", "ab"[i % 2], 9) for i in range(20)])


OPERATORS = {
    "packing": lambda d: packing.pack_documents(d, queries.tokenizer_path(queries.BYTE_BPE), queries.SEQUENCE, end_id=0).drop("sequence_id", "offset"),
    "lm": lambda d: interpolated_lm.score_texts(d, F.col("doc_id") % 2 == 0),
    "exact": lambda d: exact_dedup.exact_copies(d).drop("row__"),
    "language": lambda d: language_id.identify(d, {"en": b"one two three", "de": b"eins zwei"}, ["doc_id"]),
    "near": lambda d: near_join.near_copies(*_numbered(d)).drop("row__", "class_row__"),
    "suffix": lambda d: suffix_dedup.cleaned(d),
    "mix": lambda d: mixing.taken_words(d, queries.MIX).drop("row__", "taken"),
    "toxicity": lambda d: toxicity.scored(d, toxicity.Network(None, 0.25), ["doc_id"]),
    "divergence": lambda d: source_divergence.divergences(d, min_documents=2),
}


def _numbered(d):
    docs, row = numbered(d)
    return docs, 0.8, 0.9995, row


@pytest.mark.parametrize("name", OPERATORS)
def test_operators(spark, name):
    docs = small(spark)
    assert rows(OPERATORS[name](cluttered(docs))) == rows(OPERATORS[name](docs))


def test_trie(spark):
    talk = spark.createDataFrame([(c, t, "user", f"t{t}") for c in (0, 1, 102, 205) for t in range(4)], "conv_id long, turn long, role string, text string")
    assert rows(prefix_trie.prefix_trie(cluttered(talk))) == rows(prefix_trie.prefix_trie(talk))


@pytest.mark.parametrize("name", ["language_id", "exact_dedup", "near_join", "source_mix"])
def test_stages_keep_the_columns_and_decide_alike(spark, name):
    step = dict(corpus_pipeline.STAGES)[name]
    docs = materialize(small(spark))
    out = materialize(step(spark, cluttered(docs), SF))  # stored before the next stage is called
    plain = materialize(step(spark, docs, SF))
    assert out.columns == docs.columns + NAMES
    got = out.collect()
    assert all(r[n] == 7 for r in got for n in NAMES)
    if name != "source_mix":  # which words are taken depends on row numbers
        assert rows(out, docs.columns) == rows(plain)


def test_both_of_two_copies_are_never_kept(spark):
    docs = frame(spark, [(1, "same", "en", "s", 4), (2, "same", "en", "s", 4)]).withColumn("row__", F.lit(0))
    assert [r["doc_id"] for r in exact_dedup.deduplicated(docs).collect()] == [2]
    assert sorted(r["kept"] for r in exact_dedup.exact_copies(docs).collect()) == [False, True]


def test_no_document_gives_more_than_twice_its_words(spark):
    docs = frame(spark, [(i, "a b c" if i % 2 else "d", "en", "s", 4) for i in range(40)]).withColumn("row__", F.lit(0))
    assert all(r["taken"] <= 2 * r["size"] for r in mixing.taken_words(docs, queries.MIX).collect())


def test_rows_of_stored_files_are_told_apart_without_a_copy(spark):
    stored = materialize(frame(spark, [(i % 3, "x", "en", "s", 1) for i in range(50)]).repartition(5))
    docs, row = located(cluttered(stored).where("doc_id < 2"))
    assert row == "row____" == free_name(docs.columns[:-1], "row__") and docs.select(row).distinct().count() == docs.count() == 34
    assert "numbered" not in docs.inputFiles()[0]
    copied, _ = located(stored.union(stored))  # no place of their own
    assert copied.count() == 100 and "numbered" in copied.inputFiles()[0]
    assert rows(exact_dedup.deduplicated(stored, stored=True)) == rows(exact_dedup.deduplicated(stored))
