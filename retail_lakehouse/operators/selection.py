"""Exact selection of quantile cuts, several orders of one table at a time.

``ntile(n)`` over a table without a partition key needs only the first row of each
later bucket; every other row then finds its bucket by comparison. The rows
sought are found in four jobs, however many orders are asked for, without sorting or writing the table:

1. one mergeable quantile sketch per order brackets every cut (a cut lies
   outside its bracket about never; if it does, it is sought again in the whole range);
2. rows below a bracket are counted, rows inside are counted per key, and a running sum
   over a bracket's keys finds the key of the cut and the rank inside its run of equal keys;
3. and 4. do the same with the tie-break inside that run, so a key that a third of all
   rows share costs as little as any other.

Brackets hold about ``4 * sketch error`` of the rows, and are summed up one per task.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SKETCH_K = 4096
LEAST, MOST = -(2 ** 63), 2 ** 63 - 1
_PREFIX_BYTES = 7


def sketch_error(k: int = SKETCH_K) -> float:
    """Rank error of a KLL sketch of size ``k`` (99 % confidence), doubled."""
    return 2 * 2.296 / k ** 0.9723


def order_key(df: DataFrame, name: str, descending: bool = False) -> Column:
    """A long that orders like column ``name`` (integers, dates, decimals of up to 18 digits), NULLs first."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.DecimalType):
        if kind.precision > 18:
            raise TypeError(f"{name}: {kind.simpleString()} does not fit a long")
        c = (c * F.lit(10 ** kind.scale)).cast("long")
    elif isinstance(kind, T.DateType):
        c = F.unix_date(c).cast("long")
    elif isinstance(kind, T.IntegralType):
        c = c.cast("long")
    else:
        raise TypeError(f"{name}: no order key for {kind.simpleString()}")
    return F.coalesce(-c if descending else c, F.lit(LEAST))


def tie_key(tie: str) -> Column:
    """A string that orders like the string column ``tie``, NULL first, and is never NULL."""
    return F.coalesce(F.concat(F.lit("\x01"), F.col(tie)), F.lit(""))


def bucket_before(rows: int, n: int) -> list[int]:
    """How many rows come before each later bucket of ``ntile(n)`` that has any."""
    size, larger = divmod(rows, n)
    return [b for b in dict.fromkeys(j * size + min(j, larger) for j in range(1, n)) if 0 < b < rows]


@dataclass(frozen=True)
class Cut:
    """The row with ``before`` rows before it in one order, as far as it is known."""

    order: str
    before: int
    lo: int = LEAST
    hi: int = MOST
    key: int | None = None
    rank: int = 0  # rows of the same key before it
    run: int = 0  # rows of the same key


def _bracketed(df: DataFrame, cuts: list[Cut], key, share, k: int) -> list[Cut]:
    """``cuts`` with a bracket each: between the sketched quantiles beside its ``share`` of the rows."""
    error = sketch_error(k)
    columns = []
    for i, c in enumerate(cuts):
        sketch = F.kll_sketch_agg_bigint(key(c), F.lit(k))
        for side, r in (("lo", share(c) - error), ("hi", share(c) + error)):
            at = F.kll_sketch_get_quantile_bigint(sketch, F.lit(float(min(1.0, max(0.0, r)))))
            columns.append(at.alias(f"{side}{i}"))
    row = df.agg(*columns).first()
    return [replace(c, lo=row[f"lo{i}"], hi=row[f"hi{i}"]) for i, c in enumerate(cuts)]


def _located(df: DataFrame, cuts: list[Cut], key, fine, wanted) -> dict[int, tuple]:
    """Per cut (fine key, rows of it before the cut, rows of it). ``key`` orders the
    rows coarsely and has the bracket, ``fine`` within one coarse key. A cut outside its bracket is missing."""
    entry = [
        F.when((key(c) <= c.hi), F.struct(F.lit(i).alias("cut"), F.lit(wanted(c)).cast("long").alias("wanted"),
                                          F.when(key(c) >= c.lo, fine(c)).alias("at")))
        for i, c in enumerate(cuts)
    ]
    inside = df.select(F.explode(F.array_compact(F.array(*entry))).alias("e")).groupBy("e.cut", "e.wanted", "e.at").agg(
        F.count(F.lit(1)).alias("rows"))
    up_to = F.sum("rows").over(Window.partitionBy("cut").orderBy(F.col("at").asc_nulls_first()))
    hit = inside.withColumn("up_to", up_to).where("wanted < up_to and wanted >= up_to - rows and at is not null")
    return {r["cut"]: (r["at"], r["wanted"] - (r["up_to"] - r["rows"]), r["rows"]) for r in hit.collect()}


def _found(df: DataFrame, cuts: list[Cut], key, fine, wanted) -> dict[int, tuple]:
    """``_located``, with the whole range for cuts that were outside their brackets."""
    hits = _located(df, cuts, key, fine, wanted)
    lost = [i for i in range(len(cuts)) if i not in hits]
    if lost:
        again = _located(df, [replace(cuts[i], lo=LEAST, hi=MOST) for i in lost], key, fine, wanted)
        hits |= {lost[i]: v for i, v in again.items()}
    return hits


def quantile_starts(df: DataFrame, n: int, keys: Mapping[str, Column], tie: str, k: int = SKETCH_K) -> dict[str, list[tuple[int, str]]]:
    """For each named order (a long key, then ``tie_key(tie)``, both ascending): (key, tie key) of the first row
    of buckets 2 … n of ``ntile(n)``. ``df`` is read several times: pass a
    stored table; its ``tie`` is unique."""
    rows = df.select(*[c.alias(name) for name, c in keys.items()], tie_key(tie).alias("_tie"))

    def key(c: Cut) -> Column:
        return F.col(c.order)

    total, first, last = rows.agg(F.count(F.lit(1)), F.min("_tie"), F.max("_tie")).first()
    cuts = [Cut(name, before) for name in keys for before in bucket_before(total, n)]
    if not cuts:
        return {name: [] for name in keys}
    cuts = _bracketed(rows, cuts, key, lambda c: c.before / total, k)
    hits = _found(rows, cuts, key, key, lambda c: c.before)
    cuts = [replace(c, key=hits[i][0], rank=hits[i][1], run=hits[i][2]) for i, c in enumerate(cuts)]

    # Ties by the bytes after what all tie-breaks begin with: 7 of them fit a long.
    a, b = first.encode(), last.encode()
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    some = F.hex(F.substring(F.encode("_tie", "UTF-8"), same + 1, _PREFIX_BYTES))
    rows = rows.withColumn("_prefix", F.conv(F.rpad(some, 2 * _PREFIX_BYTES, "0"), 16, 10).cast("long"))

    def prefix(c: Cut) -> Column:
        return F.when(F.col(c.order) == c.key, F.col("_prefix"))

    cuts = _bracketed(rows, cuts, prefix, lambda c: (c.rank + 0.5) / c.run, k)
    ties = _found(rows, cuts, prefix, lambda c: F.col("_tie"), lambda c: c.rank)
    out: dict[str, list[tuple[int, str]]] = {name: [] for name in keys}
    for i, c in enumerate(cuts):
        out[c.order].append((c.key, ties[i][0]))
    return out


def bucket_by_starts(starts: list[tuple[int, str]], key: Column, tie: str) -> Column:
    """The bucket (1 …) of a row, given the first rows of the later buckets."""
    out = F.lit(1)
    for k, t in starts:
        out = out + ((key > k) | ((key == k) & (tie_key(tie) >= t))).cast("int")
    return out.cast("int")
