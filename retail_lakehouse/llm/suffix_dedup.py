"""Removal of repeated passages by a hash-compared suffix sort.

Every byte that lies in a ``LENGTH``-byte string which also starts elsewhere
(in any text, the same one included) is removed.

Bringing candidates together. Of the ``GRAM``-byte grams in a window of
``LENGTH`` bytes, the one with the smallest hash (the first, if equal) is the
window's anchor: equal windows have equal anchors at the same place. Windows
next to each other mostly share their anchor; such a run with all the bytes its
windows cover is a piece. Pieces whose anchor occurs once hold no repeated
window. Pieces that are alike as a whole (128-bit digest and anchor place) are
repeated throughout, so their bytes need not be moved. What is left goes, one
piece per digest, to the group of its anchor.

Sorting. The suffixes of a group that start at its windows are sorted by a
mergesort that compares two suffixes by their longest common extension: prefix
polynomial hashes tell in one step whether two stretches are equal, and a binary
search over the length finds where they part (nine steps for 400 bytes). Only
suffixes with the same distance to the anchor can hold equal windows, so each
distance is sorted for itself. Neighbours whose extension reaches LENGTH are
equal windows; their bytes are compared as well, and if one pair were to differ,
the group is sorted again with another hash base.

A passage in very many texts: its inner pieces are alike and resolved by digest;
groups of over ``GROUP`` different pieces are split by distance to the anchor
into parts that only meet where the bytes common to the part's windows agree.
Parts with equal bytes are counted in the map tasks and go on as one; what is
still over ``LOT_BYTES`` is cut narrower (``WIDTHS``), down to single windows.

Defined results: null text is ''; texts under LENGTH bytes keep everything;
equal rows repeat each other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache, reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lakehouse.llm.common import materialize
from retail_lakehouse.llm.tokens import slices

LENGTH = 400
GRAM = 128
SPREAD = LENGTH - GRAM + 1  # grams in a window
GROUP = 4000
UNIT = 4_000_000  # bytes hashed at a time
WIDTHS = (64, 8, 1)  # distances in a part of a split group, ever narrower
WINDOWS = 400_000  # windows sorted at a time
LOT_BYTES = 4_000_000  # bytes sorted at a time

_U = np.uint64
_PLACE = _U((1 << 24) - 1)
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xDA942042E4DD58B5, 0xA0761D6478BD642F)  # odd
CUT_FIELDS = pa.schema([("key", pa.int64()), ("part", pa.int32()), ("core", pa.int64()), ("many", pa.bool_()), ("k1", pa.int64()),
                        ("k2", pa.int64()), ("lo", pa.int64()), ("far", pa.int32()), ("data", pa.binary())])
CUT_SCHEMA = "key long, part int, core long, many boolean, k1 long, k2 long, lo long, far int, data binary"


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and its inverse modulo 2 ** 64, i < n."""
    out = []
    for b in (base, pow(base, -1, 2 ** 64)):
        p = np.full(n, _U(b), dtype=_U)
        p[0] = 1
        out.append(np.cumprod(p, dtype=_U))
    return out[0], out[1]


class PrefixHash:
    """Polynomial prefix hashes of a byte buffer: equality of any two stretches in one step."""

    def __init__(self, data: np.ndarray, base: int):
        size = 1 << max(16, int(len(data)).bit_length())
        self.power, self.inverse = _powers(base, size)
        self.sums = np.zeros(len(data) + 1, dtype=_U)
        np.cumsum((data.astype(_U) + _U(1)) * self.power[:len(data)], out=self.sums[1:])

    def stretch(self, at: np.ndarray, n) -> np.ndarray:
        return (self.sums[at + n] - self.sums[at]) * self.inverse[at]

    def extension(self, p: np.ndarray, q: np.ndarray, most: int) -> np.ndarray:
        """The longest common extension of the suffixes at p and q, up to ``most``
        bytes (which both must have), by binary search."""
        lo, hi = np.zeros(len(p), dtype=np.int64), np.full(len(p), most, dtype=np.int64)
        for _ in range(int(most).bit_length()):
            mid = (lo + hi + 1) >> 1
            same = self.stretch(p, mid) == self.stretch(q, mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo


def suffix_order(data: np.ndarray, hashes: PrefixHash, starts: np.ndarray, group: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Mergesort of the suffixes at ``starts`` within each ``group`` by their
    first ``most`` bytes: (the order, extension with the one before, -1 at a
    group's first). All merges of one round are done at once: an element's
    place is its own plus what it overtakes in the run beside it, by binary search."""
    order = np.argsort(group, kind="stable")
    starts, g = starts[order], group[order]
    n = len(order)
    first = np.flatnonzero(np.append(True, g[1:] != g[:-1])) if n else np.zeros(0, np.int64)
    size = np.diff(np.append(first, n))
    begin = np.repeat(first, size)
    end = begin + np.repeat(size, size)
    index = np.arange(n)

    def less(p, q):
        ext = hashes.extension(p, q, most)
        part = ext < most
        at = np.minimum(ext, most - 1)
        return part & (data[p + at] < data[q + at])

    width = 1
    while n and width < size.max():
        run = (index - begin) // width
        other = begin + (run ^ 1) * width
        other_end = np.minimum(other + width, end)
        left = run % 2 == 0
        lo, hi = np.minimum(other, end), np.maximum(other_end, np.minimum(other, end))
        base = lo.copy()
        # Left elements overtake smaller ones on the right; right elements those that are not greater on the left.
        active = np.flatnonzero(lo < hi)
        while len(active):
            mid = (lo[active] + hi[active]) >> 1
            mine, theirs = starts[active], starts[mid]
            before = np.where(left[active], less(theirs, mine), ~less(mine, theirs))
            lo[active] = np.where(before, mid + 1, lo[active])
            hi[active] = np.where(before, hi[active], mid)
            active = active[lo[active] < hi[active]]
        pair_begin = begin + (run - run % 2) * width
        place = pair_begin + (index - begin - run * width) + (lo - base)
        moved = np.empty_like(starts)
        moved[place] = starts
        shuffled = np.empty_like(order)
        shuffled[place] = order
        starts, order = moved, shuffled
        width *= 2
    shared = np.full(n, -1, dtype=np.int64)
    inner = np.flatnonzero(index != begin)
    shared[inner] = hashes.extension(starts[inner - 1], starts[inner], most)
    return order, shared


def repeated_windows(data: np.ndarray, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Which of the LENGTH-byte windows at ``starts`` equal another of their group."""
    for base in BASES:
        order, shared = suffix_order(data, PrefixHash(data, base), starts, group, LENGTH)
        hit = np.flatnonzero(shared >= LENGTH)
        view = np.lib.stride_tricks.sliding_window_view(data, LENGTH)
        if all((view[starts[order[h]]] == view[starts[order[h - 1]]]).all()
               for h in np.array_split(hit, max(1, len(hit) // 20_000))):
            out = np.zeros(len(starts), dtype=bool)
            out[order[hit]] = out[order[hit - 1]] = True
            return out
    raise RuntimeError("hashes collide under every base")


def runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor in texts that lie one after another (each
    ending at ``ends``): (anchor, first window, last window, anchor's hash)."""
    n = len(data) - LENGTH + 1
    empty = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, _U))
    if n <= 0:
        return empty
    grams = len(data) - GRAM + 1
    h = PrefixHash(data, BASES[0]).stretch(np.arange(grams), GRAM)
    h ^= h >> _U(33)
    h *= _U(0xFF51AFD7ED558CCD)
    h ^= h >> _U(29)
    least = (h & ~_PLACE) | np.arange(grams, dtype=_U)
    width = 1
    while width * 2 <= SPREAD:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:n], least[SPREAD - width:SPREAD - width + n])
    anchor = (least & _PLACE).astype(np.int64)
    start = np.arange(n)
    lengths = np.diff(np.concatenate([[0], ends]))
    valid = start + LENGTH <= np.repeat(ends, lengths)[:n]
    new = valid.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    last = valid.copy()
    last[:-1] &= new[1:] | ~valid[1:]
    lo, hi = np.flatnonzero(new), np.flatnonzero(last)
    return (anchor[lo], lo, hi, h[anchor[lo]]) if len(lo) else empty


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, where each text ends)."""
    texts = column.cast(pa.binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets[1:] - offsets[0]


def keyed(docs: DataFrame) -> DataFrame:
    """(k1, k2, doc_id, text): rows alike in id and text share their key, and
    need not be told apart here, as each repeats the other."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.xxhash64(F.lit(1), "doc_id", text).alias("k1"), F.xxhash64(F.lit(2), "doc_id", text).alias("k2"),
                       "doc_id", text.alias("text"))


def pieces(rows: DataFrame) -> DataFrame:
    """Every run of every text: (k1, k2, key, c1, c2, x, lo, hi), places in bytes of the text."""
    fields = ("k1", "k2", "key", "c1", "c2", "x", "lo", "hi")

    def one(data, ends, k1, k2, at):
        x, lo, hi, key = runs(data, ends)
        view = memoryview(np.ascontiguousarray(data))
        digest = [xxhash.xxh3_128_intdigest(view[a:b + LENGTH], c - a) for c, a, b in zip(x.tolist(), lo.tolist(), hi.tolist())]
        text = np.searchsorted(ends, lo, side="right")
        shift = np.concatenate([[0], ends])[text] - at
        cols = (k1[text], k2[text], key.view(np.int64), np.array([d >> 64 for d in digest], dtype=_U).view(np.int64),
                np.array([d & (2 ** 64 - 1) for d in digest], dtype=_U).view(np.int64), x - shift, lo - shift, hi - shift)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=list(fields))

    def cut(batches):
        for batch in batches:
            for part in slices(batch, "text", UNIT):
                data, ends = _bytes_of(part.column(2))
                k1, k2 = (part.column(i).to_numpy() for i in (0, 1))
                if len(data) <= 2 * UNIT:
                    yield one(data, ends, k1, k2, 0)
                else:  # a single long text, in overlapping units
                    k1, k2 = k1[-1:], k2[-1:]
                    begin = int(ends[-2]) if len(ends) > 1 else 0
                    for at in range(begin, len(data) - LENGTH + 1, UNIT):
                        unit = data[at:at + UNIT + LENGTH - 1]
                        yield one(unit, np.array([len(unit)]), k1, k2, at - begin)

    return rows.select("k1", "k2", "text").mapInArrow(cut, ", ".join(f"{f} long" for f in fields))


def wanted_pieces(shared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(spans repeated as whole pieces, pieces that must be compared): of the
    latter one per digest, ``many`` telling those already known as repeated."""
    alike = ["key", "c1", "c2"]
    kinds = shared.groupBy(*alike).agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("k1", "k2", "x", "lo", "hi")).alias("p"))
    whole = shared.join(kinds.where("m > 1").select(*alike), alike).select("k1", "k2", F.col("lo").alias("from"), (F.col("hi") + LENGTH).alias("to"))
    open_ = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("d"), F.count_if(F.col("m") == 1).alias("alone")).where("d > 1 and alone > 0")
    return whole, kinds.join(open_, "key").select("key", "p.*", (F.col("m") > 1).alias("many"), "d")


def parts_of(piece: bytes, far: int, width: int) -> list[tuple]:
    """The windows of a piece (the first ``far`` from the anchor) by distance to
    the anchor, in parts of ``width`` distances: (part, core, place in the piece,
    distance of the first window, bytes). The core stands for the bytes that all
    windows at these distances hold."""
    out = []
    for b in range((far - len(piece) + LENGTH) // width, far // width + 1):
        lo, hi = max(0, far - (b + 1) * width + 1), min(len(piece) - LENGTH, far - b * width)
        core = 0
        if width < SPREAD:
            core = xxhash.xxh3_64_intdigest(piece[far - b * width:far - (b + 1) * width + 1 + LENGTH]) - 2 ** 63
        out.append((b, core, lo, far - lo, piece[lo:hi + LENGTH]))
    return out


def settled(cuts: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """(spans of parts of split groups that are repeated as wholes, groups of
    bounded size that must be compared). Parts with equal bytes are counted in
    the map tasks and go on as one; groups still over ``LOT_BYTES`` are cut into
    narrower parts, down to single windows, which equality settles alone."""
    group = ["key", "part", "core"]
    known, bounded = [], []
    for width in (*WIDTHS[1:], None):
        # One row per distinct part, told apart by its bytes; with n = 1 the minima are its own.
        alike = [*group, "far", "data"]
        kinds = materialize(cuts.groupBy(*alike).agg(
            F.count(F.lit(1)).alias("n"), F.max("many").alias("many"), *[F.min(c).alias(c) for c in ("k1", "k2", "lo")]), "kinds")
        twice = kinds.where("n > 1").select(*alike)
        size = F.octet_length("data")
        known.append(cuts.where("not many").join(twice.hint("merge"), alike).select(
            "k1", "k2", F.col("lo").alias("from"), (F.col("lo") + size).alias("to")))
        kinds = kinds.withColumn("many", F.col("many") | (F.col("n") > 1))
        sizes = kinds.groupBy(*group).agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("d"), F.min("many").alias("all_many")).where("d > 1 and not all_many")
        left = kinds.drop("n").join(sizes.select(*group, "bytes"), group)
        columns = ["key", "part", "core", "many", "k1", "k2", "lo", "far", "data"]
        if width is None:  # single windows of one core are equal, but for a collision of cores
            bounded.append(left.select(*columns))
            break
        bounded.append(left.where(F.col("bytes") <= LOT_BYTES).select(*columns))
        large = left.where(F.col("bytes") > LOT_BYTES).select(*columns)
        cuts = materialize(narrower(large, width), "parts")
        if cuts.isEmpty():
            break
    return known, bounded


def narrower(cuts: DataFrame, width: int) -> DataFrame:
    """``cuts`` cut again into parts of ``width`` distances."""
    def cut(batches):
        for batch in batches:
            for part in slices(batch, "data", UNIT // 8):
                out = []
                for key, _, _, many, k1, k2, lo, far, data in zip(*(c.to_pylist() for c in part.columns)):
                    out += [(key, b, core, many, k1, k2, lo + at, far_, bytes_) for b, core, at, far_, bytes_ in parts_of(data, far, width)]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(CUT_FIELDS)], schema=CUT_FIELDS)

    return cuts.mapInArrow(cut, CUT_SCHEMA)


def cut_out(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of the wanted pieces, by group: (key, part, core, many, k1, k2, lo, far, data);
    ``lo`` is the first window, ``far`` its distance to the anchor."""
    lists = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("key", "x", "lo", "hi", "many", "d")).alias("list"))
    schema = CUT_FIELDS

    def cut(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                out = []
                for k1, k2, text, todo in zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                                              part.column(2).cast(pa.binary()), part.column(3).to_pylist()):
                    data = text.as_buffer()
                    for p in todo:
                        width = SPREAD if p["d"] <= GROUP else WIDTHS[0]
                        piece = bytes(data[p["lo"]:p["hi"] + LENGTH])
                        out += [(p["key"], b, core, p["many"], k1, k2, p["lo"] + at, far, part_)
                                for b, core, at, far, part_ in parts_of(piece, p["x"] - p["lo"], width)]
                for at in range(0, len(out), 5000):
                    rows_ = out[at:at + 5000]
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows_], f.type) for i, f in enumerate(schema)], schema=schema)

    # Lists grow with the corpus: sort-merge joins at every size, here and below.
    return rows.join(lists.hint("merge"), ["k1", "k2"]).select("k1", "k2", "text", "list").mapInArrow(
        cut, CUT_SCHEMA)


def compared(cuts: DataFrame) -> DataFrame:
    """Spans (k1, k2, from, to) of the windows that equal another of their group."""
    dealt = cuts.repartition("key", "part", "core").sortWithinPartitions("key", "part", "core")

    def solve(lot):
        data = np.frombuffer(b"".join(p[-1] for p in lot), dtype=np.uint8)
        size = np.array([len(p[-1]) for p in lot], dtype=np.int64)
        begin = np.cumsum(size) - size
        windows = size - LENGTH + 1
        piece = np.repeat(np.arange(len(lot)), windows)
        nth = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        number = np.array([p[0] for p in lot], dtype=np.int64)
        far = np.array([p[5] for p in lot], dtype=np.int64)
        hit = repeated_windows(data, begin[piece] + nth, number[piece] * (SPREAD + 1) + far[piece] - nth)
        hit &= ~np.array([p[1] for p in lot])[piece]
        # Neighbouring windows of one piece are one span.
        new = hit.copy()
        new[1:] &= ~hit[:-1] | (piece[1:] != piece[:-1])
        last = hit.copy()
        last[:-1] &= ~hit[1:] | (piece[1:] != piece[:-1])
        a, b = np.flatnonzero(new), np.flatnonzero(last)
        k1, k2, lo = (np.array([p[i] for p in lot], dtype=np.int64) for i in (2, 3, 4))
        return pa.RecordBatch.from_arrays(
            [pa.array(v, pa.int64()) for v in (k1[piece[a]], k2[piece[a]], lo[piece[a]] + nth[a], lo[piece[b]] + nth[b] + LENGTH)],
            names=["k1", "k2", "from", "to"])

    def run(batches):
        lot, windows, size, number = [], 0, 0, 0
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for _, members in groupby(rows, lambda r: r[:3]):
            group = [(number, *row[3:]) for row in members]
            number += 1
            if len(group) < 2:
                continue
            more_bytes = sum(len(p[-1]) for p in group)
            more = more_bytes - (LENGTH - 1) * len(group)
            if lot and (windows + more > WINDOWS or size + more_bytes > LOT_BYTES):
                yield solve(lot)
                lot, windows, size = [], 0, 0
            lot += group
            windows, size = windows + more, size + more_bytes
        if lot:
            yield solve(lot)

    return dealt.select("key", "part", "core", "many", "k1", "k2", "lo", "far", "data").mapInArrow(run, "k1 long, k2 long, from long, to long")


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(k1, k2, from, to): bytes to remove per text, overlapping, in any order."""
    found = pieces(rows)
    often = found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    shared = materialize(found.join(often, "key"), "shared-pieces")
    whole, wanted = wanted_pieces(shared)
    if shared.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > GROUP).isEmpty():
        return whole.union(compared(cut_out(rows, wanted)))
    cuts = materialize(cut_out(rows, wanted), "cuts")
    large = wanted.where(F.col("d") > GROUP).select("key").distinct()
    known, bounded = settled(cuts.join(large, "key", "left_semi"))
    spans = [whole, *known, compared(reduce(DataFrame.union, [cuts.join(large, "key", "left_anti"), *bounded]))]
    return reduce(DataFrame.union, spans)


def merged(spans: list) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that (from, to) pairs cover."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def cleaned(docs: DataFrame, keep_bytes: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_bytes, n_removed, n_spans,
    kept_sha256 and, if asked for, kept (the remaining bytes) and spans."""
    rows = keyed(docs)
    lists = repeated_spans(rows).groupBy("k1", "k2").agg(F.collect_list(F.struct("from", "to")).alias("spans"))
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    fields += [("kept", pa.binary()), ("spans", pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())])))] if keep_bytes else []
    schema = pa.schema(fields)

    def remove(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                out = []
                spans_of = part.column(2)
                for i, (doc, text) in enumerate(zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()))):
                    data, spans = text.as_py(), []
                    if spans_of[i].is_valid:
                        each = spans_of[i].values
                        spans = merged(list(zip(each.field("from").to_pylist(), each.field("to").to_pylist())))
                    kept, at = [], 0
                    for a, b in spans:
                        kept.append(data[at:a])
                        at = b
                    rest = b"".join([*kept, data[at:]])
                    row = [doc, len(data), len(data) - len(rest), len(spans), hashlib.sha256(rest).hexdigest()]
                    out.append(row + ([rest, [{"from": a, "to": b} for a, b in spans]] if keep_bytes else []))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(schema)], schema=schema)

    spark_schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (
        ", kept binary, spans array<struct<from: long, to: long>>" if keep_bytes else "")
    return rows.join(lists.hint("merge"), ["k1", "k2"], "left").select("doc_id", "text", "spans").mapInArrow(remove, spark_schema)
