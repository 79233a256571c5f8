"""Token-ID files: independent zstandard frames with a trailing seek table.

One shard file, in the public zstd seekable format:

    frame*            zstd frames; a document's ids, little-endian, 2 bytes each
                      when the vocabulary allows and else 4; a document of over
                      FRAME_BYTES spans several frames, an empty one has none
    document index    a skippable frame (magic 0x184D2A50): "<IQ" id width and
                      number of documents, then arrays of doc_id (i8), number
                      of ids (u8), number of frames (u4)
    seek table        a skippable frame (magic 0x184D2A5E): per frame compressed
                      size, raw size and checksum (low 32 bits of xxh64 of the
                      raw bytes), "<III"; footer "<IBI": number of frames,
                      descriptor 0x80 (checksums), magic 0x8F92EAB1

A reader takes the footer, the two tables and then only the frames it needs,
and verifies each by its checksum. A shard is written under a name of its own
per task attempt; the manifest row of the attempt that succeeded names it, so a
lost executor or a speculative copy can only leave files nobody refers to.
Documents lie in ascending doc_id order (null ids first) over shards and within.

Defined results: null and empty texts have the end id only; equal doc_ids stay
side by side; an empty table gives no shard.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retail_lakehouse.llm.common import materialize, shared_path, text_table
from retail_lakehouse.llm.tokens import encoder, slices

# Fixed values of the seekable format.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
CHECKSUMS = 0x80

FRAME_BYTES = 16_000_000
NULL_ID = -(2 ** 63)


def _open(path: str):
    """(file system, path in it): any store that pyarrow reads, local paths included."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


class ShardWriter:
    """Writes documents one after another; ``close`` appends index and seek table."""

    def __init__(self, sink, width: int, level: int = 3):
        self.sink, self.width, self.zstd = sink, width, zstandard.ZstdCompressor(level=level)
        self.entries, self.docs, self.counts, self.frames = [], [], [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        raw = memoryview(ids.astype(f"<u{self.width}").tobytes())
        n = 0
        for at in range(0, len(raw), FRAME_BYTES):
            part = raw[at:at + FRAME_BYTES]
            packed = self.zstd.compress(part)
            self.sink.write(packed)
            self.entries.append((len(packed), len(part), xxhash.xxh64_intdigest(part) & 0xFFFFFFFF))
            n += 1
        self.docs.append(NULL_ID if doc_id is None else doc_id)
        self.counts.append(len(ids))
        self.frames.append(n)

    def close(self) -> None:
        index = struct.pack("<IQ", self.width, len(self.docs)) + b"".join(
            np.array(v, dtype=t).tobytes() for v, t in ((self.docs, "<i8"), (self.counts, "<u8"), (self.frames, "<u4")))
        self.sink.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        table = b"".join(struct.pack("<III", *e) for e in self.entries)
        footer = struct.pack("<IBI", len(self.entries), CHECKSUMS, SEEK_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_SEEK, len(table) + len(footer)) + table + footer)


class ShardReader:
    """Random access to the documents of one shard file object."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        n, descriptor, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or descriptor != CHECKSUMS:
            raise ValueError("not a seekable shard with checksums")
        table_at = size - 9 - 12 * n
        self.table = np.frombuffer(self._at(table_at, 12 * n), dtype="<u4").reshape(-1, 3).astype(np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        head_at = int(self.begins[-1])
        magic, length = struct.unpack("<II", self._at(head_at, 8))
        if magic != SKIPPABLE_INDEX or head_at + 8 + length + 8 != table_at:
            raise ValueError("damaged document index")
        index = self._at(head_at + 8, length)
        self.width, docs = struct.unpack_from("<IQ", index)
        self.docs = np.frombuffer(index, dtype="<i8", count=docs, offset=12)
        self.counts = np.frombuffer(index, dtype="<u8", count=docs, offset=12 + 8 * docs).astype(np.int64)
        frames = np.frombuffer(index, dtype="<u4", count=docs, offset=12 + 16 * docs).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(frames)])
        self.zstd = zstandard.ZstdDecompressor()

    def _at(self, at: int, n: int) -> bytes:
        self.source.seek(int(at))
        return self.source.read(int(n))

    def ids(self, k: int) -> np.ndarray:
        """The ids of the shard's k-th document; reads its frames only."""
        parts = []
        for f in range(int(self.first[k]), int(self.first[k + 1])):
            packed, raw_size, check = (int(x) for x in self.table[f])
            raw = self.zstd.decompress(self._at(self.begins[f], packed), max_output_size=raw_size)
            if len(raw) != raw_size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
                raise ValueError(f"frame {f} fails its checksum")
            parts.append(raw)
        ids = np.frombuffer(b"".join(parts), dtype=f"<u{self.width}").astype("<u4")
        if len(ids) != self.counts[k]:
            raise ValueError(f"document {k} is incomplete")
        return ids


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write shards under ``folder``, an
    address that every executor reaches. Returns the manifest, one row per
    shard: (shard, path, n_docs, n_tokens); it is written too, so a reader
    never runs the writers again."""
    schema = pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])

    def write(batches):
        enc = encoder(tokenizer)
        width = 2 if max(len(enc.opens) - 1, end_id) < 2 ** 16 else 4
        shard, writer, sink, path = TaskContext.get().partitionId(), None, None, ""
        try:
            for batch in batches:
                for part in slices(batch, "text"):
                    if writer is None:
                        path = f"{folder}/shard-{shard:07d}-{uuid.uuid4().hex}.zst"
                        fs, place = _open(path)
                        fs.create_dir(place.rsplit("/", 1)[0], recursive=True)
                        sink = fs.open_output_stream(place, buffer_size=1 << 20, compression=None)
                        writer = ShardWriter(sink, width)
                    ids, counts = enc.encode(part.column(1))
                    at = 0
                    for doc, n in zip(part.column(0).to_pylist(), counts.tolist()):
                        writer.add(doc, np.append(ids[at:at + n], np.uint32(end_id)))
                        at += n
            if writer is not None:
                writer.close()
        finally:
            if sink is not None:
                sink.close()
        if writer is not None:
            yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [path], "n_docs": [len(writer.docs)],
                                              "n_tokens": [int(sum(writer.counts))]}, schema=schema)

    ordered = text_table(docs, "doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first())
    manifest = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text").mapInArrow(
        write, "shard int, path string, n_docs long, n_tokens long")
    return materialize(manifest, "token-manifest")


def read_token_files(manifest: DataFrame, keep_ids: bool = False) -> DataFrame:
    """Every document of the shards in ``manifest``: (doc_id, start, n_tokens,
    ids_crc32[, ids]); ``start`` counts the ids of all documents before it.
    One task reads one shard, one frame at a time."""
    base = F.coalesce(F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + (
        [("ids", pa.list_(pa.int64()))] if keep_ids else [])
    schema = pa.schema(fields)

    def read(batches):
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, place = _open(path)
                with fs.open_input_file(place) as source:
                    shard, rows = ShardReader(source), [[] for _ in fields]
                    for k in range(len(shard.docs)):
                        ids, doc = shard.ids(k), int(shard.docs[k])
                        row = [None if doc == NULL_ID else doc, start, len(ids), zlib.crc32(ids.tobytes())]
                        for col, v in zip(rows, row + ([ids.tolist()] if keep_ids else [])):
                            col.append(v)
                        start += len(ids)
                        if len(rows[0]) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)
                            rows = [[] for _ in fields]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)

    spark = manifest.sparkSession
    shards = max(1, manifest.count())
    spread = manifest.select("path", base.alias("start")).repartition(min(shards, 4 * spark.sparkContext.defaultParallelism))
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if keep_ids else ""))


def token_files(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int, keep_ids: bool = False) -> DataFrame:
    """Write ``docs`` to new files in the shared folder and read them back."""
    return read_token_files(write_token_files(docs, shared_path(spark, "token-files"), tokenizer, end_id), keep_ids)
