"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

Texts are sets of five-word shingles (a text of fewer words is one shingle).
Rows with equal sets are one class and go on as one row. A class has
``TREES`` labels of ``DEPTH`` MinHash values; the forest keeps each tree's
labels sorted, so that neighbours share the longest prefixes. Prefixes are
shortened from the full depth until pairs at the threshold meet in some tree
with probability ``target_recall``: ``shortened_depth`` gives the length, a
tree's bucket is then a prefix of that length. In each bucket every class
meets its next neighbours in sorted order and the bucket's first class; pairs
whose signatures agree too little are dropped (``SLACK`` standard errors below
the threshold). Connected candidates form a group. Buckets whose classes are
then still in several groups are resolved in full: the signatures of all pairs
across groups are compared, in pairs of blocks of ``SIGNATURES`` classes, and
likely pairs join their groups.

Verification is exact and complete: within a group all pairs are compared on
their shingle sets, in blocks of ``BLOCK`` classes, each pair of blocks being
one piece of work; neither candidates nor links are emitted one by one, a piece
returns a link count per class and a spanning forest of its links.

A group of copies that holds a third of all rows is one class; a group of near
copies is spread over pairs of blocks, its buckets over salted sub-buckets of
``SUB_BUCKET`` rows that the bucket's first class, or else the comparison across
groups, ties together.

Defined results: null text is ''; texts without words form one class and have
no links but to each other; equal rows are counted each; an empty table gives
an empty result.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_lakehouse.llm.common import materialize, numbered, text_table
from retail_lakehouse.llm.components import components
from retail_lakehouse.llm.tokens import slices, strings

WORDS = 5
TREES = 16
DEPTH = 8
SLACK = 5.0
NEIGHBOURS = 2
SUB_BUCKET = 20_000
SKETCH_BYTES = 4_000_000  # text sketched at a time
SIGNATURES = 4096  # of a block compared within a bucket
BLOCK = 512
_SEED = 0x5EED

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of every text as 64-bit hashes, sorted within the
    text, one text after another, and how many each text has."""
    split = pc.ascii_split_whitespace(texts)
    words = split.flatten()
    ends = split.offsets.to_numpy().astype(np.int64)
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    per_text = np.add.reduceat(np.append(real, False), ends[:-1]) * (np.diff(ends) > 0) if len(texts) else np.zeros(0, np.int64)
    words = words.filter(pa.array(real)).dictionary_encode()
    hashed = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in strings(words.dictionary)), dtype=_U, count=len(words.dictionary))
    h = hashed[words.indices.to_numpy()] if len(words) else np.zeros(0, _U)
    starts = np.concatenate([[0], np.cumsum(per_text)]).astype(np.int64)
    n = np.where(per_text >= WORDS, per_text - WORDS + 1, (per_text > 0).astype(np.int64))
    text = np.repeat(np.arange(len(texts)), n)
    first = np.arange(n.sum()) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.repeat(starts[:-1], n)
    width = np.minimum(per_text, WORDS)[text]
    x = _mix(width.astype(_U) + _U(_SEED))
    padded = np.append(h, np.zeros(WORDS, _U))
    for j in range(WORDS):
        x = np.where(width > j, _mix(x * _U(0x9E3779B97F4A7C15) + padded[first + j]), x)
    order = np.lexsort((x, text))
    x, text = x[order], text[order]
    new = np.ones(len(x), dtype=bool)
    new[1:] = (x[1:] != x[:-1]) | (text[1:] != text[:-1])
    return x[new], np.bincount(text[new], minlength=len(texts)).astype(np.int64)


def _hash_family() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(_SEED)
    return (rng.integers(0, 2 ** 63, TREES * DEPTH, dtype=np.uint64) * _U(2) + _U(1),
            rng.integers(0, 2 ** 63, TREES * DEPTH, dtype=np.uint64))


def min_hashes(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """MinHash values, one row per non-empty set (uint32)."""
    filled = counts > 0
    starts = np.concatenate([[0], np.cumsum(counts[filled])[:-1]]).astype(np.int64)
    out = np.zeros((int(filled.sum()), TREES * DEPTH), dtype=np.uint32)
    if len(out):
        for k, (a, b) in enumerate(zip(*_hash_family())):
            out[:, k] = np.minimum.reduceat(((shingles * a + b) >> _U(32)).astype(np.uint32), starts)
    return out


def shortened_depth(threshold: float, target_recall: float) -> int:
    """The longest prefix at which a pair of ``threshold`` similarity meets in
    one of the trees with probability ``target_recall``, from the full depth down."""
    for depth in range(DEPTH, 0, -1):
        if 1 - (1 - threshold ** depth) ** TREES >= target_recall:
            return depth
    raise ValueError("no prefix reaches this recall: use more trees")


def sketches(docs: DataFrame, depth: int) -> DataFrame:
    """Per row: row__, doc_id, n_shingles, digest of the set, 8-bit signature and
    per tree the shortened prefix and the rest of the label, both as longs."""
    schema = pa.schema([("row__", pa.int64()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()),
                        ("d1", pa.int64()), ("d2", pa.int64()), ("signature", pa.binary()),
                        ("prefix", pa.list_(pa.int64())), ("rest", pa.list_(pa.int64()))])

    def sketch(batches):
        for batch in batches:
            for part in slices(batch, "text", SKETCH_BYTES):
                sh, counts = shingle_sets(part.column(2))
                at = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
                digest = [np.where(counts > 0, np.add.reduceat(np.append(_mix(sh * _U(k)), _U(0)), np.minimum(at, len(sh))), _U(0))
                          .view(np.int64) for k in (3, 5)]
                mh = min_hashes(sh, counts)
                rows = np.zeros((len(counts), TREES * DEPTH), dtype=np.uint32)
                rows[counts > 0] = mh
                labels = rows.reshape(len(counts), TREES, DEPTH).astype(_U)
                prefix = np.zeros((len(counts), TREES), dtype=_U)
                for d in range(depth):
                    prefix = _mix(prefix * _U(0x9E3779B97F4A7C15) + labels[:, :, d] + _U(1))
                rest = np.zeros((len(counts), TREES), dtype=_U)
                for d in range(depth, DEPTH):
                    rest = (rest << _U(15)) | (labels[:, :, d] & _U(0x7FFF))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(counts), *(pa.array(d) for d in digest),
                     pa.array([r.tobytes() for r in rows.astype(np.uint8)], pa.binary()),
                     pa.array(list(prefix.view(np.int64)), pa.list_(pa.int64())),
                     pa.array(list(rest.view(np.int64)), pa.list_(pa.int64()))], schema=schema)

    return text_table(docs, "row__", "doc_id", "text").mapInArrow(
        sketch, "row__ long, doc_id long, n_shingles long, d1 long, d2 long, signature binary, prefix array<long>, rest array<long>")


def forest_buckets(classes: DataFrame) -> DataFrame:
    """(id, tree, prefix, rest, members, leader) of the buckets with several classes."""
    labels = classes.where("n_shingles > 0").select("id", F.posexplode(F.arrays_zip("prefix", "rest")).alias("tree", "l")).select(
        "id", "tree", F.col("l.prefix").alias("prefix"), F.col("l.rest").alias("rest"))
    buckets = labels.groupBy("tree", "prefix").agg(F.count(F.lit(1)).alias("members"), F.min("id").alias("leader")).where("members > 1")
    return labels.join(buckets, ["tree", "prefix"])


def forest_pairs(inside: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) of class ids: neighbours within the buckets."""
    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("members") / SUB_BUCKET))
    order = Window.partitionBy("tree", "prefix", "part").orderBy("rest", "id")
    inside = inside.withColumn("part", part)
    met = inside.select("id", F.array("leader", *[F.lead("id", k).over(order) for k in range(1, NEIGHBOURS + 1)]).alias("others"))
    pairs = met.select("id", F.explode("others").alias("other")).where("other is not null and other != id")
    return pairs.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def least_agreement(threshold: float) -> float:
    return threshold - SLACK * (threshold * (1 - threshold) / (TREES * DEPTH)) ** 0.5


def likely(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose 8-bit signatures and set sizes allow the threshold."""
    values = TREES * DEPTH
    least = least_agreement(threshold)
    sig = classes.select("id", "signature", "n_shingles")
    both = pairs.join(sig.toDF("a", "sa", "na"), "a").join(sig.toDF("b", "sb", "nb"), "b").where(
        F.least("na", "nb") >= threshold * F.greatest("na", "nb"))

    def agree(batches):
        for batch in batches:
            names = batch.schema.names
            x, y = (np.frombuffer(b"".join(batch.column(names.index(c)).to_pylist()), dtype=np.uint8).reshape(-1, values) for c in ("sa", "sb"))
            ok = (x == y).mean(axis=1) >= least
            yield pa.RecordBatch.from_arrays([batch.column(names.index(c)).filter(pa.array(ok)) for c in ("a", "b")], names=["a", "b"])

    return both.select("a", "b", "sa", "sb").mapInArrow(agree, "a long, b long")


def agreements(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many values each signature of ``x`` shares with each of ``y``."""
    if len(x) * len(y) <= 4096:
        return (x[:, None, :] == y[None, :, :]).sum(axis=2)
    out = np.zeros((len(x), len(y)), dtype=np.uint8)
    columns = np.ascontiguousarray(y.T)
    for k in range(x.shape[1]):
        out += (x[:, k, None] == columns[k]).view(np.uint8)
    return out


def bridges(root: np.ndarray, size: np.ndarray, signature: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Likely pairs (one of ``at_a``, one of ``at_b``) that join all the groups
    which any likely pair of the two blocks joins."""
    least, out = least_agreement(threshold) * signature.shape[1], []
    _, group = np.unique(root, return_inverse=True)
    at_a = at_a[np.argsort(group[at_a], kind="stable")]
    for lo in range(0, len(at_a), 64):
        a = at_a[lo:lo + 64]
        own = group[a[0]]
        b = at_b[group[at_b] != own] if (group[a] == own).all() else at_b
        if not len(b):
            continue
        ok = agreements(signature[a], signature[b]) >= least
        ok &= np.minimum(size[a][:, None], size[b]) >= threshold * np.maximum(size[a][:, None], size[b])
        for i in np.flatnonzero(ok.any(axis=1)):
            other = b[ok[i]]
            other = other[group[other] != group[a[i]]]
            while len(other):
                out.append((int(a[i]), int(other[0])))
                group[group == group[other[0]]] = group[a[i]]
                other = other[group[other] != group[a[i]]]
    return out


def missed_pairs(inside: DataFrame, classes: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """Likely pairs (a, b) across ``groups`` (vertex, root) from all pairs of each
    bucket's members, a spanning forest of them for each pair of blocks. Members
    of a bucket's largest group are not compared with each other; buckets whose
    members are in one group, or have all met as neighbours, are left out."""
    grouped = classes.select("id", "n_shingles", "signature").join(groups, F.col("id") == F.col("vertex"), "left").select(
        "id", "n_shingles", "signature", F.coalesce("root", "id").alias("root"))
    crowded = inside.where(F.col("members") > NEIGHBOURS + 1).select("tree", "prefix", "id", "members").join(grouped.select("id", "root"), "id")
    sizes = crowded.groupBy("tree", "prefix", "root").agg(F.count(F.lit(1)).alias("n"), F.first("members").alias("members"))
    mixed = sizes.groupBy("tree", "prefix").agg(F.max(F.struct("n", "root")).alias("most"), F.first("members").alias("members")).where(
        "most.n < members").select("tree", "prefix", F.col("most.root").alias("main"), F.ceil(F.col("most.n") / SIGNATURES).cast("int").alias("mains"),
                                   F.ceil((F.col("members") - F.col("most.n")) / SIGNATURES).cast("int").alias("others"))
    salt, main = F.xxhash64("id"), F.col("root") == F.col("main")
    last = F.col("mains") + F.col("others") - 1
    placed = crowded.join(mixed, ["tree", "prefix"]).select(
        "tree", "prefix", "id", F.when(main, F.pmod(salt, F.col("mains"))).otherwise(F.col("mains") + F.pmod(salt, F.col("others"))).cast("int").alias("block"),
        F.when(main, F.col("mains")).otherwise(F.lit(0)).alias("from"), last.alias("last"))
    pieces = placed.join(grouped, "id").select("*", F.explode(F.sequence("from", "last")).alias("with")).select(
        "tree", "prefix", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "id", "root", "n_shingles", "signature")
    dealt = pieces.repartition("tree", "prefix", "i", "j").sortWithinPartitions("tree", "prefix", "i", "j", "id")

    def work(key, rows):
        _, _, i, j = key
        block, ids, root, size = (np.array([r[k] for r in rows]) for k in range(4))
        signature = np.frombuffer(b"".join(r[4] for r in rows), dtype=np.uint8).reshape(len(rows), -1)
        return [(int(ids[a]), int(ids[b])) for a, b in bridges(root, size, signature, np.flatnonzero(block == i), np.flatnonzero(block == j), threshold)]

    def run(batches):
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for key, piece in groupby(rows, lambda r: r[:4]):
            found = work(key, [r[4:] for r in piece])
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(2)], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def linked(sets_a: tuple, sets_b: tuple, threshold: float, same: bool) -> np.ndarray:
    """Boolean matrix of links between two blocks of (shingles, counts)."""
    (xa, na), (xb, nb) = sets_a, sets_b
    # Only shingles on both sides (or in two sets of one block) can be shared.
    shared, inverse = np.unique(np.concatenate([xa, xb]), return_inverse=True)
    ia, ib = inverse[:len(xa)], inverse[len(xa):]
    ra, rb = np.repeat(np.arange(len(na)), na), np.repeat(np.arange(len(nb)), nb)
    count_a, count_b = np.bincount(ia, minlength=len(shared)), np.bincount(ib, minlength=len(shared))
    use = (count_a > 1) if same else (count_a > 0) & (count_b > 0)
    column = np.cumsum(use) - 1
    common = np.zeros((len(na), len(nb)), dtype=np.float32)
    total = int(use.sum())
    for lo in range(0, total, 4096):
        width = min(4096, total - lo)
        mats = []
        for i, r, n in ((ia, ra, len(na)), (ib, rb, len(nb))):
            c = column[i] - lo
            mine = use[i] & (c >= 0) & (c < width)
            m = np.zeros((n, width), dtype=np.float32)
            m[r[mine], c[mine]] = 1
            mats.append(m)
        common += mats[0] @ mats[1].T
    union = na[:, None] + nb[None, :] - common
    # The slack is far below the least step of a ratio of set sizes.
    links = common >= threshold * union - 1e-6
    if same:
        np.fill_diagonal(links, False)
    return links


def _spanning(links: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links between two blocks."""
    root: dict[int, int] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(links)):
        a, b = int(ids_a[i]), int(ids_b[j])
        ra, rb = find(a), find(b)
        if ra != rb:
            root[max(ra, rb)] = min(ra, rb)
            out.append((a, b))
    return out


def verified(members: DataFrame, threshold: float) -> DataFrame:
    """All links within groups: from (id, root, weight, text) to rows (id,
    other, links): ``links`` documents that ``id`` links to, found by one piece
    of work, or (``other`` not null) an edge of the spanning forest."""
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    placed = members.join(sizes, "root").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).drop("n")
    pieces = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with")).select(
        "root", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "id", "weight", "text")
    dealt = pieces.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "id")

    def work(key, rows):
        _, i, j = key
        block = np.array([r[0] for r in rows])
        ids, weight = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
        x, n = shingle_sets(pa.array([r[3] for r in rows], pa.string()))
        ends = np.concatenate([[0], np.cumsum(n)])

        def pick(which):
            at = np.flatnonzero(which)
            return at, (np.concatenate([x[ends[k]:ends[k + 1]] for k in at]) if len(at) else x[:0], n[at])

        (at_a, a), (at_b, b) = pick(block == i), pick(block == j)
        links = linked(a, b, threshold, i == j)
        counts = [(int(ids[k]), None, int(c)) for k, c in zip(at_a, links @ weight[at_b]) if c]
        if i != j:
            counts += [(int(ids[k]), None, int(c)) for k, c in zip(at_b, links.T @ weight[at_a]) if c]
        return counts + [(p, q, 0) for p, q in _spanning(links, ids[at_a], ids[at_b])]

    def run(batches):
        key, rows = None, []
        for batch in batches:
            for root, i, j, *row in zip(*(strings(c) for c in batch.columns)):
                if key != (root, i, j):
                    if rows:
                        yield from _emit(work(key, rows))
                    key, rows = (root, i, j), []
                rows.append(row)
        if rows:
            yield from _emit(work(key, rows))

    return dealt.mapInArrow(run, "id long, other long, links long")


def _emit(rows: list[tuple]):
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], names=["id", "other", "links"])


def near_copies(docs: DataFrame, threshold: float = 0.8, target_recall: float = 0.9995, row: str = "row__") -> DataFrame:
    """One row per row of ``docs`` (doc_id, text and their number ``row``), which is row__ in the result: class_id, the
    smallest doc_id that the document is connected with by links; copy_id, the
    smallest doc_id with the same shingle set; n_links, the number of other
    documents (copies included) whose similarity reaches ``threshold``; and
    class_row__, the row number of the class's first row."""
    docs = docs.select(F.col(row).alias("row__"), "doc_id", "text")
    table = materialize(sketches(docs, shortened_depth(threshold, target_recall)), "sketches")
    same = ["n_shingles", "d1", "d2"]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row__")).alias("first")
    sets = table.groupBy(*same).agg(first, F.count(F.lit(1)).alias("weight"))
    chosen = sets.select(*same, F.col("first.row__").alias("id"), F.col("first.doc_id").alias("copy_id"), "weight")
    classes = materialize(table.join(chosen.select("id", "weight", "copy_id"), F.col("row__") == F.col("id")).drop("row__", "doc_id"), "classes")
    inside = materialize(forest_buckets(classes), "buckets")
    groups = components(materialize(likely(forest_pairs(inside), classes, threshold), "pairs"))
    missed = materialize(missed_pairs(inside, classes, groups, threshold), "missed")
    if not missed.isEmpty():
        groups = components(groups.select(F.col("vertex").alias("a"), F.col("root").alias("b")).union(missed))
    # Members grow with the corpus: a sort-merge join at every size.
    listed = groups.join(classes.select("id", "weight"), F.col("vertex") == F.col("id")).select("id", "root", "weight")
    members = text_table(docs, "row__", "text").join(listed.hint("merge"), F.col("row__") == F.col("id")).select("id", "root", "weight", "text")
    found = materialize(verified(members, threshold), "links")
    links = found.where("other is null").groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    known = classes.select("id", *same, "weight", "copy_id").join(links, "id", "left").join(
        roots, F.col("id") == F.col("vertex"), "left").withColumn("class_row__", F.coalesce("root", "id"))
    least = known.groupBy("class_row__").agg(F.min("copy_id").alias("class_id"))
    known = known.join(least, "class_row__").select(
        *same, "class_row__", "class_id", "copy_id", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return table.select("doc_id", "row__", *same).join(known, same).select(
        "doc_id", "row__", "class_id", "copy_id", "n_links", "class_row__")


def without_near_copies(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``docs`` with one row of each class of connected near copies."""
    rows, row = numbered(docs)
    kept = near_copies(rows, threshold, row=row).where("row__ = class_row__").select(F.col("row__").alias(row))
    return rows.join(kept.hint("merge"), row, "left_semi").drop(row)
