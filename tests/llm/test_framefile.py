import io
import zlib

import numpy as np
import pytest
import zstandard
from tokenizers import Tokenizer

from retail_lakehouse.llm import framefile, queries
from retail_lakehouse.llm.common import shared_path
from llm_helpers import SF, edge_rows, frame

PATH = queries.tokenizer_path(queries.WORD_BPE)


class Source(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def expected(rows, end=2):
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, end]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=str)


def as_rows(df):
    return sorted([(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in df.collect()], key=str)


def test_edge_rows(spark):
    rows = edge_rows()
    docs = frame(spark, rows).selectExpr("*", "1 as start", "'x' as path")
    assert as_rows(framefile.token_files(spark, docs, PATH, 2)) == expected([r[:2] for r in rows])


def test_documents(spark):
    docs = queries.documents(spark, SF)
    assert as_rows(queries.op9_token_files(spark, SF)) == expected([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_empty_table(spark):
    assert framefile.token_files(spark, frame(spark, []), PATH, 2).count() == 0


def written(docs, width=2):
    sink = io.BytesIO()
    w = framefile.ShardWriter(sink, width)
    for doc, ids in docs:
        w.add(doc, np.array(ids, dtype=np.uint32))
    w.close()
    return sink.getvalue()


def test_round_trip_and_random_access(monkeypatch):
    monkeypatch.setattr(framefile, "FRAME_BYTES", 64)
    rng = np.random.default_rng(0)
    docs = [(i if i else None, rng.integers(0, 60_000, int(n))) for i, n in enumerate([5, 0, 1000, 32, 33, 1])]
    for width in (2, 4):
        data = written(docs, width)
        shard = framefile.ShardReader(Source(data))
        for k in (4, 0, 5, 1, 2, 3):
            assert shard.ids(k).tolist() == docs[k][1].tolist()
        assert shard.docs[0] == framefile.NULL_ID
        # A plain zstandard reader sees the raw ids one after another and skips the tables.
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        assert raw == np.concatenate([d for _, d in docs]).astype(f"<u{width}").tobytes()


def test_reads_only_the_frames_asked_for():
    data = written([(i, np.arange(1000) + i) for i in range(50)])
    reads = []

    class Counting(Source):
        def read(self, n=-1):
            reads.append(n)
            return super().read(n)

    shard = framefile.ShardReader(Counting(data))
    reads.clear()
    shard.ids(7)
    assert len(reads) == 1 and reads[0] < len(data) / 40


def test_damage_is_found():
    data = bytearray(written([(1, np.arange(5000) % 7000), (2, np.arange(100))]))
    shard = framefile.ShardReader(Source(bytes(data)))
    data[int(shard.begins[0]) + int(shard.table[0, 0]) - 3] ^= 0xFF
    damaged = framefile.ShardReader(Source(bytes(data)))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        damaged.ids(0)
    assert damaged.ids(1).tolist() == list(range(100))
    with pytest.raises(ValueError):
        framefile.ShardReader(Source(bytes(data[:-1]) + b"x"))


def test_manifest_names_every_shard(spark):
    docs = spark.range(0, 500).selectExpr("id as doc_id", "concat('text ', id) as text").repartition(4)
    manifest = framefile.write_token_files(docs, shared_path(spark, "t"), PATH, 2)
    assert manifest.agg({"n_docs": "sum"}).first()[0] == 500
    assert framefile.read_token_files(manifest, keep_ids=True).where("size(ids) = n_tokens").count() == 500
