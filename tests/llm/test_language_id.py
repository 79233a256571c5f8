import unicodedata
import zlib

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import functions as F

from llm_helpers import edge_rows, frame
from retail_lakehouse.llm import language_id, queries


def test_held_out_accuracy(spark):
    docs = {r["doc_id"]: r["lang"] for r in queries.documents(spark, "/root/testdata/sf0.01").collect()}
    found = queries.op5_language_id(spark, "/root/testdata/sf0.01").collect()
    assert len(found) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    held = [r for r in found if r["held_out"]]
    assert sum(r["lang_pred"] == docs[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found)
    assert sum(r["rejected"] for r in found) <= 0.01 * len(found)


def test_prediction_needs_the_text_only(spark):
    docs = queries.documents(spark, "/root/testdata/sf0.01")
    learned = queries.language_dictionaries(docs)
    a = language_id.identify(docs, learned, ["doc_id"]).collect()
    b = language_id.identify(docs.selectExpr("doc_id", "text", "'zz' as lang", "'q' as source"), learned, ["doc_id"]).collect()
    assert a == b


def test_edge_rows(spark):
    docs = frame(spark, edge_rows()).selectExpr("*", "1 as score", "'x' as text__")
    learned = queries.language_dictionaries(queries.documents(spark, "/root/testdata/sf0.01"))
    found = language_id.identify(docs, learned, docs.columns).collect()
    assert len(found) == len(edge_rows())
    for r in found:
        if r["doc_id"] in (3, 4, 6):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        else:
            assert r["lang_pred"] in learned
    assert [r["text"] for r in found] == [r[1] for r in edge_rows()]


def test_nothing_learned_and_empty_table(spark):
    docs = frame(spark, edge_rows())
    assert language_id.learn(docs.where("doc_id = 4")) == {}
    assert {r["lang_pred"] for r in language_id.identify(docs, {}, ["doc_id"]).collect()} == {"und"}
    empty = frame(spark, [])
    assert language_id.learn(empty) == {} and language_id.identify(empty, {}, ["doc_id"]).count() == 0


def test_narrow_margins_are_rejected():
    same = language_id.compressors({"a": b"one two three", "b": b"one two three"})
    assert language_id.classify("four five", same, 0.002) == ("a", 0.0, True)
    far = language_id.compressors({"a": b"one two three four five six seven", "b": b"uno dos tres"})
    assert language_id.classify("one two three four five six seven", far, 0.002)[::2] == ("a", False)
    assert language_id.classify("one two three four five six seven", far, 0.99)[2]


def test_letters_only():
    assert language_id.letters_only(pa.array(["A b!! 12c", None, "É\n\nx", " 3 "])) == ["a b c", "", "é x", ""]


def test_every_snippet_teaches(spark):
    letters = "бвгджзклмн"
    words = ["".join(letters[int(c)] for c in f"{i:06d}") for i in range(language_id.SNIPPETS)]
    rows = [(i, " ".join([w] * 28), "ru", "s", 195) for i, w in enumerate(words)]
    learned = language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    assert set(words) <= set(learned["ru"].decode().split())
    assert len(learned["ru"]) + language_id.SEGMENT_BYTES <= 1 << language_id._PARAMETERS["window_log"]


def test_every_row_against_plain_python(spark):
    """The same dictionaries, every text by itself, no table of compressors, no Arrow."""
    docs = queries.documents(spark, "/root/testdata/sf0.01")
    learned = queries.language_dictionaries(docs)
    level = zstd.ZstdCompressionParameters(**language_id._PARAMETERS)
    packers = {lang: zstd.ZstdCompressor(dict_data=zstd.ZstdCompressionDict(d, dict_type=zstd.DICT_TYPE_RAWCONTENT), compression_params=level)
               for lang, d in learned.items()}

    def plain(text):
        words = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in (text or "").lower()).split(" ")
        raw = " ".join(w for w in words if w).encode()
        if not any(c.isalpha() for c in raw.decode()):
            return "und", 0.0
        pieces = [raw[i:i + 700] for i in range(0, len(raw), 700)]
        size = {lang: sum(len(p.compress(x)) for x in pieces) for lang, p in packers.items()}
        best, second = sorted(size.values())[:2]
        return min(lang for lang in size if size[lang] == best), 1 - best / second

    for r in language_id.identify(docs, learned, ["doc_id", "text"]).collect():
        lang, score = plain(r["text"])
        assert r["lang_pred"] == lang and abs(r["score"] - score) < 1e-12


def test_sample_is_the_smallest_hashes_in_any_partitioning(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SNIPPETS", 20)
    monkeypatch.setattr(language_id, "SAMPLED", 60)
    docs = spark.range(20_000).selectExpr("id as doc_id", "concat('w', id % 7, ' text of ', id) as text", "if(id % 3 = 0, 'aa', 'bb') as lang")
    again = docs.unionByName(spark.range(5000).selectExpr("7L as doc_id", "concat('copy ', id) as text", "'bb' as lang"))
    rows = [tuple(r) for r in docs.select("lang", F.xxhash64("doc_id"), "text").collect()]
    want = {lang: " ".join(language_id.letters_only(pa.array([t for _, _, t in sorted(r for r in rows if r[0] == lang)[:20]]))).encode()
            for lang in ("aa", "bb")}
    assert language_id.learn(docs) == want
    assert language_id.learn(docs.repartition(50)) == want
    for parts in (2, 80):
        assert language_id.sampled(again.repartition(parts)).count() < 200


def test_one_language_or_none(spark):
    docs = spark.createDataFrame([(None, "some words", "aa"), (None, "other words", "aa"), (1, None, "bb"), (2, "x", None)], "doc_id long, text string, lang string")
    assert set(language_id.learn(docs)) == {"aa"}
    assert language_id.learn(docs.limit(0)) == {}
