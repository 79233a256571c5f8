"""Source divergence audit by in-mapper stripes: which sources of a language write unlike the others, and in which terms.

Each task folds whole documents into hash stripes: (language, term) -> {source:
(document frequency, count)}. A task that holds ``SPILL_ENTRIES`` entries hands its
stripes to the shuffle and begins anew, so its memory is bounded whatever it reads.
Stripes of one key meet sorted, are merged one key at a time, and only those in
enough documents of their language stay. The merged stripes, dealt into slices of
about ``SLICE_TERMS`` terms, then emit the divergences themselves: a slice has the
counts of all sources for its terms, so it sums the differences of every pair of
sources over its terms and names each source's leading terms; slices are added up.

A source that holds a third of all rows adds one entry to a stripe; a term that
every document holds crosses the shuffle once per spill. A stripe has at most one
entry per source of its language, of which the result has a row per pair.

Probabilities are integers: 1 + floor(10^9 (count + 5) / (N + 5 V)), by long
division in base 1000, exact for N + 5 V up to 9 * 10^15.

Defined results: null text, lang and source count as ''; a document is a row, so
repeated rows count repeatedly; ties of value go by the item's UTF-8 bytes; a
group without terms has counts 0; a language without kept terms has pair values 0
and no term rows; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_lakehouse.llm.common import buckets_for, materialize
from retail_lakehouse.llm.tokens import slices, strings

MIN_DOCUMENTS = 30
TOP_TERMS = 50
SMOOTHING = 5
SCALE = 10 ** 9
SPILL_ENTRIES = 400_000
SLICE_TERMS = 4096
ROWS_OUT = 20_000

# Lower-cased ASCII letters and all bytes of non-ASCII characters.
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_BREAK = re.compile(rb"[^a-z\x80-\xff]")
_PIECE = 4_000_000
_ONE_DOCUMENT = 1 << 40  # an entry's number: documents * 2^40 + count

STRIPE = "lang string, term binary, docs long, sources array<string>, counts array<long>"
MERGED = "lang string, term binary, sources array<string>, counts array<long>"


def term_counts(text: str) -> Counter:
    """How often each term occurs in a whole text; long ones are read piece by piece."""
    raw = text.encode("utf-8", "surrogatepass").lower()  # bytes: only A-Z
    found, at = Counter(), 0
    while at < len(raw):
        cut = _BREAK.search(raw, at + _PIECE) if len(raw) - at > _PIECE else None
        end = cut.start() if cut else len(raw)
        found.update(_TERM.findall(raw, at, end))
        at = end
    return found


def spilled(stripes: dict[str, dict[bytes, dict[str, int]]]):
    """The stripes of a task as batches for the shuffle."""
    for lang, terms in stripes.items():
        keys = list(terms)
        for at in range(0, len(keys), ROWS_OUT):
            some = keys[at:at + ROWS_OUT]
            entries = [terms[t] for t in some]
            ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, entries), np.int64, len(entries)))])
            packed = np.fromiter(chain.from_iterable(e.values() for e in entries), np.int64, int(ends[-1]))
            sources = pa.array(chain.from_iterable(entries), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some), pa.string()), pa.array(some, pa.binary()),
                 pa.array(np.add.reduceat(packed // _ONE_DOCUMENT, ends[:-1])),
                 pa.ListArray.from_arrays(ends.astype(np.int32), sources),
                 pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(packed % _ONE_DOCUMENT))],
                names=["lang", "term", "docs", "sources", "counts"])


def folded(docs: DataFrame, spill_entries: int = SPILL_ENTRIES) -> DataFrame:
    """Partial stripes of ``docs`` (lang, source, text without nulls)."""

    def fold(batches):
        stripes: dict[str, dict[bytes, dict[str, int]]] = {}
        held = 0
        for batch in batches:
            for part in slices(batch, "text"):
                langs, sources, texts = (strings(part.column(c)) for c in ("lang", "source", "text"))
                for lang, source, text in zip(langs, sources, texts):
                    terms = stripes.setdefault(lang, {})
                    for term, n in term_counts(text).items():
                        entries = terms.get(term)
                        if entries is None:
                            terms[term] = {source: _ONE_DOCUMENT + n}
                            held += 1
                        else:
                            held += source not in entries
                            entries[source] = entries.get(source, 0) + _ONE_DOCUMENT + n
                    if held >= spill_entries:
                        yield from spilled(stripes)
                        stripes, held = {}, 0
        yield from spilled(stripes)

    return docs.mapInArrow(fold, STRIPE)


def runs_of(batch: pa.RecordBatch, min_documents: int):
    """Runs of one key in a sorted batch, as (key, docs, {source: count}): the first and
    the last, which may go on in other batches, and those in between that reach ``min_documents``."""
    lang, term, docs, sources, counts = batch.columns
    n = batch.num_rows
    new = np.ones(n, dtype=bool)
    for c in (lang, term):
        same = pc.equal(c.slice(1), c.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        new[1:] = new[1:] & same if c is lang else ~(new[1:] & same)
    begin = np.flatnonzero(new)
    total = np.add.reduceat(docs.to_numpy(), begin)
    wanted = total >= min_documents
    wanted[[0, -1]] = True
    ends = sources.offsets.to_numpy()
    run = np.repeat(np.cumsum(new) - 1, np.diff(ends))
    coded, n_of = sources.flatten().dictionary_encode(), counts.flatten().to_numpy()
    names, width = coded.dictionary.to_pylist(), len(coded.dictionary)
    kept = np.flatnonzero(wanted[run])
    cell = run[kept] * width + coded.indices.to_numpy()[kept]
    order = np.argsort(cell, kind="stable")
    cell, n_of = cell[order], n_of[kept][order]
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    sums, cell = np.add.reduceat(n_of, first), cell[first]
    found: dict[int, dict[str, int]] = {}
    for r, s, c in zip((cell // width).tolist(), (cell % width).tolist(), sums.tolist()):
        found.setdefault(r, {})[names[s]] = c
    for r in np.flatnonzero(wanted).tolist():
        at = int(begin[r])
        yield (lang[at].as_py(), term[at].as_py()), int(total[r]), found[r]


def merged_stripes(partial: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """One stripe per (lang, term) that is in at least ``min_documents`` documents."""

    def batch_of(rows):
        (lang, term), sources, counts = zip(*[k for k, *_ in rows]), [list(e) for _, _, e in rows], [list(e.values()) for _, _, e in rows]
        return pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(term, pa.binary()), pa.array(sources, pa.list_(pa.string())),
             pa.array(counts, pa.list_(pa.int64()))], names=["lang", "term", "sources", "counts"])

    def merge(batches):
        key, docs, entries, out = None, 0, {}, []
        for batch in batches:
            if not batch.num_rows:
                continue
            for k, n, e in runs_of(batch, min_documents):
                if k == key:  # the run that the batch before ended with
                    docs += n
                    for s, c in e.items():
                        entries[s] = entries.get(s, 0) + c
                    continue
                if docs >= min_documents:
                    out.append((key, docs, entries))
                key, docs, entries = k, n, e
            if len(out) >= ROWS_OUT:
                yield batch_of(out)
                out = []
        if docs >= min_documents:
            out.append((key, docs, entries))
        if out:
            yield batch_of(out)

    met = partial.repartition("lang", "term").sortWithinPartitions("lang", "term")
    return met.mapInArrow(merge, MERGED)


def scaled(counts: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (counts + 5) / (total + 5 * terms)), exactly; counts at most total."""
    rest, whole = counts + SMOOTHING, total + SMOOTHING * terms
    out = np.zeros(np.broadcast(rest, whole).shape, dtype=np.int64)
    for _ in range(3):  # 10^9 = 1000^3
        rest = rest * 1000
        digit = rest // whole
        rest = rest - digit * whole
        out = out * 1000 + digit
    return out + 1


def slice_divergences(top: int):
    """For one slice of a language's stripes and all its groups: rows (lang,
    source, part, item, value) with pair sums over the slice and the slice's leading terms."""

    def emit(stripes: pa.Table, groups: pa.Table) -> pa.Table:
        lang = groups.column("lang")[0].as_py()
        sources = groups.column("source").to_pylist()
        n_group = np.array(groups.column("n").to_pylist(), dtype=np.int64)
        n_terms = groups.column("v")[0].as_py()
        n_lang, place, width = n_group.sum(), {s: i for i, s in enumerate(sources)}, len(sources)
        terms = stripes.column("term").to_pylist() if stripes.num_rows else []
        sums = np.zeros((width, width), dtype=np.int64)
        leading: list[list[tuple[int, bytes]]] = [[] for _ in sources]
        step = max(1, 4_000_000 // width)
        for at in range(0, len(terms), step):
            part = stripes.slice(at, step)
            counts = np.zeros((part.num_rows, width), dtype=np.int64)
            for r, (ss, cs) in enumerate(zip(part.column("sources").to_pylist(), part.column("counts").to_pylist())):
                counts[r, [place[s] for s in ss]] = cs
            p = scaled(counts, n_group[None, :], n_terms)
            q = scaled(counts.sum(axis=1), n_lang, n_terms)
            for i in range(width):
                sums[i, i + 1:] += np.abs(p[:, i + 1:] - p[:, i:i + 1]).sum(axis=0)
                over = np.flatnonzero((counts[:, i] > 0) & (p[:, i] > q))
                values = (p[:, i] - q)[over]
                if len(over) > top:  # all that reach the top-th value; ties are settled below
                    least = np.partition(values, len(values) - top)[len(values) - top]
                    over, values = over[values >= least], values[values >= least]
                found = leading[i] + [(-int(v), terms[at + int(r)]) for v, r in zip(values, over)]
                leading[i] = sorted(found)[:top]
        rows = [(sources[i], "pair", sources[j], int(sums[i, j])) for i in range(width) for j in range(i + 1, width)]
        rows += [(sources[i], "term", t.decode("utf-8", "replace"), -v) for i in range(width) for v, t in leading[i]]
        source, part, item, value = zip(*rows) if rows else ((), (), (), ())
        return pa.table({"lang": pa.array([lang] * len(rows), pa.string()), "source": pa.array(source, pa.string()),
                         "part": pa.array(part, pa.string()), "item": pa.array(item, pa.string()),
                         "value": pa.array(value, pa.int64())})

    return emit


def divergences(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS,
                spill_entries: int = SPILL_ENTRIES, slice_terms: int = SLICE_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) of ``docs`` (text, lang, source)."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    stripes = materialize(merged_stripes(folded(rows, spill_entries), min_documents), "stripes")
    n_slices = buckets_for(stripes.count(), slice_terms)
    each = stripes.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("entry"))
    totals = each.groupBy("lang", F.col("entry.sources").alias("source")).agg(F.sum("entry.counts").alias("n"))
    kept = stripes.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    zero = F.lit(0).cast("long")
    groups = (rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(kept, "lang", "left")
              .select("lang", "source", F.coalesce("n", zero).alias("n"), F.coalesce("v", zero).alias("v"),
                      F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1))).alias("slice")))
    dealt = stripes.withColumn("slice", F.pmod(F.xxhash64("term"), F.lit(n_slices)).cast("int"))
    found = dealt.groupBy("lang", "slice").cogroup(groups.groupBy("lang", "slice")).applyInArrow(
        slice_divergences(top), "lang string, source string, part string, item string, value long")
    found = materialize(found, "slice-divergences")
    summed = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    turned = summed.select("lang", F.col("item").alias("source"), "part", F.col("source").alias("item"), "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = summed.unionByName(turned).withColumn("rank", F.row_number().over(order))
    terms = found.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.unionByName(terms)


ORACLE = r"""
with docs as (
    select row_number() over () as rn, coalesce(lang, '') as lang, coalesce(source, '') as source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
    from documents),
words as (select rn, lang, source, unnest(terms) as term from docs),
counted as (select rn, lang, source, term, count(*) as n from words group by all),
kept as (select lang, term, sum(n) as n from counted group by lang, term having count(*) >= 30),
sizes as (select lang, count(*) as v, sum(n) as n from kept group by lang),
used as (select c.lang, c.source, c.term, sum(c.n) as n from counted c join kept using (lang, term) group by all),
groups as (
    select g.lang, g.source, coalesce(sum(u.n), 0) as n
    from (select distinct lang, source from docs) g left join used u on g.lang = u.lang and g.source = u.source
    group by all),
p as (
    select g.lang, g.source, k.term, coalesce(u.n, 0) as n,
           1 + (1000000000 * (coalesce(u.n, 0) + 5)::hugeint) // (g.n + 5 * s.v)::hugeint as p
    from groups g join kept k on k.lang = g.lang join sizes s on s.lang = g.lang
         left join used u on u.lang = g.lang and u.source = g.source and u.term = k.term),
q as (
    select k.lang, k.term, 1 + (1000000000 * (k.n + 5)::hugeint) // (s.n + 5 * s.v)::hugeint as q
    from kept k join sizes s on s.lang = k.lang),
pairs as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(sum(abs(x.p - y.p)), 0) as value
    from groups a join groups b on a.lang = b.lang and a.source <> b.source
         left join p x on x.lang = a.lang and x.source = a.source
         left join p y on y.lang = b.lang and y.source = b.source and y.term = x.term
    group by all),
terms as (
    select p.lang, p.source, 'term' as part, p.term as item, p.p - q.q as value
    from p join q on q.lang = p.lang and q.term = p.term where p.n > 0 and p.p > q.q),
ranked as (
    select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
    from (select * from pairs union all select * from terms))
select lang, source, part, item, value::bigint as value, rank::integer as rank
from ranked where part = 'pair' or rank <= 50"""
