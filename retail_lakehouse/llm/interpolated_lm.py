"""Language-model scoring by deleted interpolation.

The model gives a token w after h (the word before it, or the text's start)

    P(w | h) = l2[b] c(h, w) / c(h)  +  l1[b] c(w) / N  +  l0[b] / (V + 1)

with maximum-likelihood estimates from all training texts and weights by the
bucket b of the context's frequency c(h) (powers of two, unseen apart). The
weights come from expectation-maximisation on held-out counts: each training
text is held out in turn, its own counts deleted from the estimates, and its
tokens are counted by (bucket, bin of c(h, w) / c(h), bin of c(w)); a bin is an
eighth of an octave, so the table that the driver iterates on is bounded by the
bins and not by the corpus. Counts themselves are exact and cover every text.

How counts meet texts: texts are taken in blocks (consecutive rows, about
``BLOCK_BYTES``). A block lists its distinct words and word pairs once, as sorted
64-bit hashes with its training counts, cut into ``buckets`` by hash range. One
shuffle brings each range together, where totals over all blocks are formed, and
every list gets its totals back in its own order, so that no key travels twice.
A second shuffle brings them to the block's texts. A pair that is frequent is
one entry per block, whatever its number of occurrences. The texts are scanned
twice; a block is named by its contents, so a scan that were to cut blocks
otherwise would be noticed (``_complete``) and fail instead of giving wrong counts.

Defined results: a null or empty text is its end token; equal rows count each;
without training texts the model is uniform over the one unknown type (score 0);
an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lakehouse.llm.common import materialize, text_table
from retail_lakehouse.llm.near_join import _mix
from retail_lakehouse.llm.tokens import slices, strings

BLOCK_BYTES = 6_000_000
BINS = 8  # per octave
ROUNDS = 60
NONE = -(10 ** 6)  # bin of a zero count

_U = np.uint64
_START, _END = _U(0x5354415254), _U(0x454E44)
_STATS = "stats"


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token hashes, context hashes, tokens per text): words in A-Z lower case, then one end."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, ends = split.flatten(), split.offsets.to_numpy().astype(np.int64)
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    n = np.diff(np.concatenate([[0], np.cumsum(real)])[ends])
    coded = words.filter(pa.array(real)).dictionary_encode()
    known = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in strings(coded.dictionary)), dtype=_U, count=len(coded.dictionary))
    h = known[coded.indices.to_numpy()] if len(coded) else np.zeros(0, _U)
    count = n + 1
    is_end = np.zeros(int(count.sum()), dtype=bool)
    is_end[np.cumsum(count) - 1] = True
    token = np.full(len(is_end), _END, dtype=_U)
    token[~is_end] = h
    context = np.concatenate([[_START], token[:-1]]) if len(token) else token
    context[np.cumsum(count) - count] = _START
    return token, context, count


def keys_of(token: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _mix(token + _U(1)), _mix(_mix(context + _U(7)) * _U(0x9E3779B97F4A7C15) + token)


def _packed(numbers: np.ndarray) -> bytes:
    """Byte planes, compressed: small numbers have empty high planes."""
    raw = np.ascontiguousarray(numbers, dtype="<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(raw).tobytes())


def _unpacked(data: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data, max_output_size=max(1, 8 * n)), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(8, n).T).view("<u8").reshape(-1)


def _block_name(part: pa.RecordBatch) -> str:
    """128 bits of the block's rows."""
    h = xxhash.xxh3_128()
    ids, texts = part.column(0), part.column(2)
    h.update(repr(ids.to_pylist()).encode())
    h.update(pc.binary_length(texts).to_numpy(zero_copy_only=False).tobytes())
    h.update("".join(strings(texts)).encode())
    return h.hexdigest()


def _cuts(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket numbers present, where each begins) of sorted keys."""
    bucket = ((keys >> _U(32)) * _U(buckets)) >> _U(32)
    return np.unique(bucket.astype(np.int64), return_index=True)


def _train_totals(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, training count of each)."""
    distinct, which = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(which[train], minlength=len(distinct)).astype(_U)


ROUTED = "block string, bucket long, kind int, n long, keys binary, counts binary"


def requests(docs: DataFrame, buckets: int) -> DataFrame:
    """Per block, kind (0 words, 1 pairs) and hash range: its keys and training counts."""

    def ask(batches):
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES):
                token, context, count = tokens_of(part.column(2))
                train = np.repeat(part.column(1).to_numpy(zero_copy_only=False), count)
                name = _block_name(part)
                for kind, keys in enumerate(keys_of(token, context)):
                    distinct, counts = _train_totals(keys, train)
                    numbers, at = _cuts(distinct, buckets)
                    rows = [(name, int(b), kind, int(e - s), _packed(np.diff(distinct[s:e], prepend=_U(0))), _packed(counts[s:e]))
                            for b, s, e in zip(numbers, at, [*at[1:], len(distinct)])]
                    yield _routed(rows)

    return docs.mapInArrow(ask, ROUTED)


def _routed(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
    names = ("block", "bucket", "kind", "n", "keys", "counts")
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=list(names))


def _by_key(batches, n_keys: int):
    """Groups of consecutive rows with equal leading columns."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:n_keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:n_keys], []
            rows.append(row[n_keys:])
    if rows:
        yield key, rows


def totals(asked: DataFrame) -> DataFrame:
    """The requests with ``counts`` replaced by the totals over all blocks (no
    keys), and per range one row of block 'stats': training tokens and types."""
    dealt = asked.select("bucket", "kind", "block", "n", "keys", "counts").repartition("bucket", "kind").sortWithinPartitions("bucket", "kind")

    def add(batches):
        for (bucket, kind), rows in _by_key(batches, 2):
            keys = [np.cumsum(_unpacked(r[2], r[1]), dtype=_U) for r in rows]
            counts = np.concatenate([_unpacked(r[3], r[1]) for r in rows])
            distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
            # Exact in doubles up to 2**53 occurrences.
            total = np.bincount(which, weights=counts, minlength=len(distinct)).astype(_U)
            ends = np.cumsum([0, *(r[1] for r in rows)])
            out = [(r[0], bucket, kind, r[1], None, _packed(total[which[s:e]])) for r, s, e in zip(rows, ends, ends[1:])]
            if kind == 0:
                out.append((_STATS, int(counts.sum()), kind, int((total > 0).sum()), None, None))
            for lo in range(0, len(out), 200):
                yield _routed(out[lo:lo + 200])

    return dealt.mapInArrow(add, ROUTED)


def block_texts(docs: DataFrame) -> DataFrame:
    """The blocks' rows themselves, compressed, as kind 2."""

    def give(batches):
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema) as out:
                    out.write_batch(part)
                raw = sink.getvalue()
                yield _routed([(_block_name(part), 0, 2, len(raw), zstandard.ZstdCompressor(level=3).compress(raw), None)])

    return docs.mapInArrow(give, ROUTED)


EVENTS = ("doc_id long, train boolean, n_tokens long, own binary, pairs binary, "
          "bucket int, pair_bin int, word_bin int, tokens long, types long")


def _complete(kind: int, distinct: np.ndarray, got: dict, buckets: int) -> np.ndarray:
    """The totals of a block's keys, put together in key order."""
    numbers, at = _cuts(distinct, buckets)
    parts = []
    for b, n in zip(numbers.tolist(), np.diff(np.append(at, len(distinct))).tolist()):
        if (kind, b) not in got or got[kind, b][0] != n:
            raise RuntimeError("the second scan cut the blocks differently: store the documents first")
        parts.append(_unpacked(got[kind, b][1], n))
    return np.concatenate(parts) if parts else np.zeros(0, _U)


def _own_counts(which: np.ndarray, text: np.ndarray) -> np.ndarray:
    """How often each token's key occurs in the token's own text."""
    _, at, n = np.unique(text * np.int64(which.max(initial=0) + 1) + which, return_inverse=True, return_counts=True)
    return n[at]


def frequency_bucket(context_count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, then one bucket per power of two."""
    return np.where(context_count > 0, np.floor(np.log2(np.maximum(context_count, 1))) + 1, 0).astype(np.int32)


def _bin(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, np.floor(BINS * np.log2(np.where(x > 0, x, 1))), NONE).astype(np.int32)


_BIN_BITS = 21


def _cells(bucket: np.ndarray, *bins: np.ndarray) -> tuple[np.ndarray, ...]:
    """(bucket, bin, bin, how often): the distinct combinations, counted by one
    sort of a packed number."""
    code = bucket.astype(np.int64)
    for b in bins:
        code = (code << _BIN_BITS) | np.where(b == NONE, 0, b.astype(np.int64) + (1 << (_BIN_BITS - 1)))
    code, n = np.unique(code, return_counts=True)
    out = []
    for _ in bins:
        b = code & ((1 << _BIN_BITS) - 1)
        out.append(np.where(b == 0, NONE, b - (1 << (_BIN_BITS - 1))))
        code = code >> _BIN_BITS
    return (code, *out[::-1], n)


def _after(count_w: np.ndarray, first: np.ndarray, starts: float | np.ndarray) -> np.ndarray:
    """Each token's context count: that of the token before it, or of the start."""
    out = np.concatenate([[0], count_w[:-1]])
    out[first] = starts
    return out


def events(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows of three sorts: per text its tokens' counts c(w) and c(h, w); per
    (bucket, pair_bin, word_bin) of a block its held-out tokens; training totals."""
    answers = totals(requests(docs, buckets))
    routed = answers.union(block_texts(docs)).repartition("block").sortWithinPartitions("block", "kind")
    schema = pa.schema([("doc_id", pa.int64()), ("train", pa.bool_()), ("n_tokens", pa.int64()), ("own", pa.binary()), ("pairs", pa.binary()),
                        ("bucket", pa.int32()), ("pair_bin", pa.int32()), ("word_bin", pa.int32()), ("tokens", pa.int64()), ("types", pa.int64())])

    def out(columns: dict, n: int):
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    def meet(batches):
        for (block,), rows in _by_key(batches, 1):
            if block == _STATS:
                yield out({"tokens": [sum(r[0] for r in rows)], "types": [sum(r[2] for r in rows)]}, 1)
                continue
            got = {(r[1], r[0]): (r[2], r[4]) for r in rows if r[1] < 2}
            for r in rows:
                if r[1] == 2:
                    raw = zstandard.ZstdDecompressor().decompress(r[3], max_output_size=r[2])
                    yield from read(pa.ipc.open_stream(raw).read_all().combine_chunks().to_batches()[0], got)

    def read(part, got):
        token, context, count = tokens_of(part.column(2))
        train_doc = part.column(1).to_numpy(zero_copy_only=False)
        train = np.repeat(train_doc, count)
        text = np.repeat(np.arange(len(count)), count)
        first, ends = np.cumsum(count) - count, np.cumsum(count)
        found, own = [], []
        for kind, keys in enumerate(keys_of(token, context)):
            distinct, which = np.unique(keys, return_inverse=True)
            found.append(_complete(kind, distinct, got, buckets)[which].astype(np.int64))
            own.append(_own_counts(which, text))
        del token, context, keys, distinct, which
        c_w, c_hw = found
        # Training texts = occurrences of the end = occurrences of the start.
        starts = int(c_w[ends[0] - 1]) if len(ends) else 0
        c_h = _after(c_w, first, starts)
        yield out({"doc_id": part.column(0), "train": part.column(1), "n_tokens": count,
                   "own": [_packed(c_w[s:e]) for s, e in zip(first, ends)],
                   "pairs": [_packed(c_hw[s:e]) for s, e in zip(first, ends)]}, len(count))
        left_h = (c_h - _after(own[0], first, 1))[train]
        left_hw, left_w = (c_hw - own[1])[train], (c_w - own[0])[train]
        ratio = left_hw / np.maximum(left_h, 1)
        bucket, pair_bin, word_bin, n = _cells(frequency_bucket(left_h), _bin(ratio), _bin(left_w))
        yield out({"bucket": bucket, "pair_bin": pair_bin, "word_bin": word_bin, "tokens": n}, len(n))

    return routed.select("block", "bucket", "kind", "n", "keys", "counts").mapInArrow(meet, EVENTS)


def learn_weights(cells: list[tuple[int, int, int, int]], n_tokens: int, n_types: int) -> dict[int, np.ndarray]:
    """EM per bucket from (bucket, pair_bin, word_bin, held-out tokens). Each
    component starts with one event of its own, so no weight reaches zero."""
    out = {}
    value = lambda b: np.where(b == NONE, 0.0, 2.0 ** ((np.maximum(b, -9000) + 0.5) / BINS))
    table = np.array(cells, dtype=np.float64).reshape(-1, 4)
    for bucket in np.unique(table[:, 0]):
        rows = table[table[:, 0] == bucket]
        p = np.stack([np.minimum(value(rows[:, 1]), 1), value(rows[:, 2]) / max(n_tokens, 1), np.full(len(rows), 1 / (n_types + 1))], axis=1)
        w = np.full(3, 1 / 3)
        for _ in range(ROUNDS):
            share = p * w
            got = (share / share.sum(axis=1, keepdims=True) * rows[:, 3:]).sum(axis=0) + 1
            w = got / got.sum()
        out[int(bucket)] = w
    return out


def scored(table: DataFrame, weights: dict[int, np.ndarray], n_tokens: int, n_types: int, n_texts: int) -> DataFrame:
    """Scores from stored events: one row per text."""
    by_bucket = np.full((64, 3), 1 / 3)
    for b in range(64):
        # A bucket without held-out tokens has the weights of the one below it.
        by_bucket[b] = weights.get(b, by_bucket[b - 1] if b else np.full(3, 1 / 3))
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def score(batches):
        for batch in batches:
            ids, train, count, own, pairs = (c.to_pylist() for c in batch.columns)
            known, base, model = [], [], []
            for n, w, hw in zip(count, own, pairs):
                c_w, c_hw = _unpacked(w, n).astype(np.int64), _unpacked(hw, n).astype(np.int64)
                c_h = _after(c_w, np.array([0]), n_texts)
                weight = by_bucket[frequency_bucket(c_h)]
                # An unseen context has no estimate: its share goes to the other two.
                weight = np.where((c_h > 0)[:, None], weight, weight * [0, 1, 1] / np.maximum(weight[:, 1:].sum(axis=1), 1e-300)[:, None])
                p = weight[:, 0] * c_hw / np.maximum(c_h, 1) + weight[:, 1] * c_w / max(n_tokens, 1) + weight[:, 2] / (n_types + 1)
                if not n_tokens:
                    p = np.ones(n)
                known.append(int((c_w > 0).sum()))
                base.append(float(np.log10((c_w + 0.5) / (n_tokens + 0.5 * (n_types + 1))).sum()))
                model.append(float(np.log10(p).sum()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip((ids, [not t for t in train], count, known, [n_tokens] * len(ids), base, model), schema)], schema=schema)

    return table.select("doc_id", "train", "n_tokens", "own", "pairs").mapInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score_texts(docs: DataFrame, train) -> DataFrame:
    """Learn from the rows of ``docs`` (doc_id, text) where the column ``train``
    holds, score all: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    source = text_table(docs.withColumn("train__", F.coalesce(train, F.lit(False))), "doc_id", "train__", "text")
    buckets = max(1, source.rdd.getNumPartitions())
    table = materialize(events(source, buckets), "lm-events")
    stats = table.where("types is not null").agg(F.sum("tokens"), F.sum("types")).first()
    n_tokens, n_types = stats[0] or 0, stats[1] or 0
    cells = table.where("bucket is not null").groupBy("bucket", "pair_bin", "word_bin").agg(F.sum("tokens").alias("n")).collect()
    texts = table.where("doc_id is not null or n_tokens is not null")
    n_texts = texts.where("train").count()
    weights = learn_weights(sorted(tuple(r) for r in cells), n_tokens, n_types)
    return scored(texts, weights, n_tokens, n_types, n_texts)
