"""URL filters by temporal list join, in DataFrame functions only.

List entries (pattern, action, listed_at) say from when on a pattern is
blocked, allowed or off the list ("remove"). A pattern is a host, a parent
domain of hosts (a single label as well), or a host with leading path segments;
the case of its host does not count. Entries of one pattern
become validity intervals: each holds until the next one. A capture is judged
by the entries active at its fetch time; of these the most specific decides
(more path segments, then more host labels).

The as-of join is an equi-join on (pattern, month) with the interval as the
remaining condition: an interval is listed under every month it touches up to
the last fetch, so a pattern with a long history is compared within one month
only, and a host that has a third of all captures is spread over the months.
Captures are made distinct on (url, fetch time) first. The number of path
prefixes tried is the largest number of segments on the list.

Defined results: a null url, one without a host, or a null fetch time matches
nothing (decision 'none'); entries with a null field are ignored; of entries of
one pattern with one time, block wins over allow over remove; repeated captures
each get their row; empty tables give empty results or 'none' throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"


def host(url: Column) -> Column:
    """Lower-case host name, null if there is none."""
    found = F.lower(F.regexp_extract(url, HOST, 1))
    return F.when(found != "", found)


def segments(url: Column) -> Column:
    """Non-empty path segments."""
    return F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda s: s != "")


def intervals(entries: DataFrame) -> DataFrame:
    """(pattern, action, valid_from, valid_to): half-open, valid_to null while it still holds."""
    rank = F.array_position(F.array(F.lit("remove"), F.lit("allow"), F.lit("block")), F.col("action"))
    cut = F.instr("pattern", "/")
    name = F.when(cut > 0, F.substring("pattern", F.lit(1), cut - 1)).otherwise(F.col("pattern"))
    pattern = F.concat(F.lower(name), F.when(cut > 0, F.substr("pattern", cut)).otherwise(F.lit("")))
    dated = entries.select(pattern.alias("pattern"), "action", "listed_at").where(
        "pattern is not null and action is not null and listed_at is not null")
    # One entry per pattern and time, then each lasts until the next.
    single = dated.groupBy("pattern", F.col("listed_at").alias("valid_from")).agg(
        F.max(F.struct(rank.alias("rank"), "action"))["action"].alias("action"))
    after = F.lead("valid_from").over(Window.partitionBy("pattern").orderBy("valid_from"))
    return single.withColumn("valid_to", after).where("action != 'remove'")


def _patterns(depth: Column) -> Column:
    """All patterns that cover a capture with ``host`` and ``segments``, each
    with its specificity (path segments, host labels)."""
    labels = F.split("host", r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.struct(F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern"),
                           F.lit(0).alias("path_len"), (F.size(labels) - i + 1).alias("labels")))
    n = F.least(F.size("segments"), depth)
    paths = F.transform(
        F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")),
        lambda k: F.struct(F.concat(F.col("host"), F.lit("/"), F.array_join(F.slice("segments", 1, k), "/")).alias("pattern"),
                           k.alias("path_len"), F.size(labels).alias("labels")))
    return F.concat(domains, paths)


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """One row per row of ``captures`` (url, fetched_at, any further columns but
    those added): host, decision ('block', 'allow', 'none'), pattern and
    valid_from of the entry that decided, n_active entries."""
    valid = intervals(entries)
    asked = (captures.select("url", "fetched_at").where("fetched_at is not null").distinct()
             .select("url", "fetched_at", host(F.col("url")).alias("host"), segments(F.col("url")).alias("segments"))
             .where("host is not null"))
    depth = valid.agg(F.coalesce(F.max(F.size(F.split("pattern", "/")) - 1), F.lit(0)).alias("depth"))
    last = captures.agg(F.max("fetched_at").alias("last"))
    keyed = asked.withColumn("depth", depth.scalar()).select(
        "url", "fetched_at", F.trunc("fetched_at", "month").alias("month"), F.explode(_patterns(F.col("depth"))).alias("p")
    ).select("url", "fetched_at", "month", "p.*")
    until = F.coalesce(F.col("valid_to"), F.col("last"))
    monthly = (valid.withColumn("last", last.scalar()).where("valid_from <= last")
               .select("pattern", "action", "valid_from", "valid_to",
                       F.explode(F.sequence(F.trunc("valid_from", "month"), F.trunc(F.least(until, F.col("last")), "month"),
                                            F.expr("interval 1 month"))).alias("month")))
    active = keyed.join(monthly, ["pattern", "month"]).where(
        "valid_from <= fetched_at and (valid_to is null or fetched_at < valid_to)")
    decided = active.groupBy("url", "fetched_at").agg(
        F.max(F.struct("path_len", "labels", "action", "pattern", "valid_from")).alias("best"),
        F.count(F.lit(1)).alias("n_active"))
    kept = [c for c in captures.columns if c not in ("host", "decision", "pattern", "valid_from", "n_active")]
    return captures.select(*kept).join(decided, ["url", "fetched_at"], "left").select(
        *kept, host(F.col("url")).alias("host"), F.coalesce(F.col("best.action"), F.lit("none")).alias("decision"),
        F.col("best.pattern").alias("pattern"), F.col("best.valid_from").alias("valid_from"),
        F.coalesce("n_active", F.lit(0)).alias("n_active"))


def _digits(text: Column, at: int, n: int) -> Column:
    return F.conv(F.substring(F.md5(text), at, n), 16, 10).cast("bigint")


def captures_of(pages: DataFrame) -> DataFrame:
    """``pages`` as captures: each fetched at an hour of 2024 that its id gives."""
    hour = F.pmod(F.col("page_id") * 7919, F.lit(8784))
    return pages.select("page_id", "url", F.timestamp_add("HOUR", hour.cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("fetched_at"))


def list_of(pages: DataFrame) -> DataFrame:
    """A dated list over what occurs in ``pages``: of the hosts, their parent
    domains and their first path segments, those whose md5 is even, each with
    up to four dated entries that the md5 gives."""
    h, seg = host(F.col("url")), segments(F.col("url"))
    found = pages.select(h.alias("host"), F.get(seg, F.lit(0)).alias("first")).where("host is not null").distinct()
    patterns = found.select(F.explode(F.array_compact(F.array(
        F.col("host"), F.substring_index("host", ".", -2),
        F.concat(F.col("host"), F.lit("/"), F.col("first"))))).alias("pattern")).distinct()
    listed = patterns.where(_digits(F.col("pattern"), 1, 4) % 2 == 0)
    entry = listed.select("pattern", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k")).withColumn(
        "tag", F.concat("pattern", F.lit("#"), F.col("k").cast("string")))
    action = F.element_at(F.array(F.lit("block"), F.lit("allow"), F.lit("remove")), (_digits(F.col("tag"), 1, 4) % 3 + 1).cast("int"))
    day = (_digits(F.col("tag"), 5, 4) % 366).cast("int")
    return entry.select("pattern", action.alias("action"),
                        F.timestamp_add("DAY", day, F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("listed_at"))


ORACLE = r"""
with url_parts as (
  select page_id, url,
         timestamp '2024-01-01 00:00:00' + to_hours(((page_id * 7919) % 8784)::int) as fetched_at,
         nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '') as host,
         [s for s in string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1), '/') if s != ''] as segs
  from pages
), raw_patterns as (
  select distinct unnest([host, array_to_string(string_split(host, '.')[-2:], '.'),
                          case when len(segs) > 0 then host || '/' || segs[1] end]) as pattern
  from url_parts where host is not null
), tags as (
  select pattern, pattern || '#' || k::varchar as tag
  from raw_patterns, range(4) r(k)
  where pattern is not null and ('0x' || substr(md5(pattern), 1, 4))::bigint % 2 = 0
), entries as (
  select lower(split_part(pattern, '/', 1)) || substr(pattern, length(split_part(pattern, '/', 1)) + 1) as pattern,
         ['block', 'allow', 'remove'][('0x' || substr(md5(tag), 1, 4))::bigint % 3 + 1] as action,
         timestamp '2024-01-01 00:00:00' + to_days((('0x' || substr(md5(tag), 5, 4))::bigint % 366)::int) as listed_at
  from tags
), single as (
  select pattern, listed_at as valid_from, max(case action when 'remove' then 1 when 'allow' then 2 else 3 end) as rank
  from entries group by all
), spans as (
  select pattern, ['remove', 'allow', 'block'][rank] as action, valid_from,
         lead(valid_from) over (partition by pattern order by valid_from) as valid_to
  from single
), cover as (
  select distinct url, fetched_at, host, segs, string_split(host, '.') as labels from url_parts where host is not null
), keyed as (
  select url, fetched_at, array_to_string(labels[i:], '.') as pattern, 0 as path_len, len(labels) - i + 1 as labels
  from (select *, unnest(range(1, len(labels) + 1)) as i from cover)
  union all
  select url, fetched_at, host || '/' || array_to_string(segs[1:k], '/'), k, len(labels)
  from (select *, unnest(range(1, len(segs) + 1)) as k from cover)
), decided as (
  select url, fetched_at, count(*) as n_active,
         arg_max(action, row(path_len, labels, action, s.pattern)) as action,
         arg_max(s.pattern, row(path_len, labels, action, s.pattern)) as pattern,
         arg_max(valid_from, row(path_len, labels, action, s.pattern)) as valid_from
  from keyed k join spans s on s.pattern = k.pattern
  where action != 'remove' and valid_from <= fetched_at and (valid_to is null or fetched_at < valid_to)
  group by url, fetched_at
)
select u.page_id, u.url, u.fetched_at, u.host, coalesce(d.action, 'none') as decision, d.pattern, d.valid_from,
       coalesce(d.n_active, 0) as n_active
from url_parts u left join decided d on u.url = d.url and u.fetched_at = d.fetched_at
"""
