import datetime as dt
import re

from llm_helpers import SF
from retail_lakehouse.llm import queries, url_lists

RANK = {"remove": 1, "allow": 2, "block": 3}


def t(day, hour=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day, hours=hour)


def covers(url):
    m = re.match(r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", url or "")
    if not m:
        return []
    host = m[1].lower()
    path = re.match(r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", url)[1]
    segs, labels = [s for s in path.split("/") if s], host.split(".")
    out = [(".".join(labels[i:]), 0, len(labels) - i) for i in range(max(1, len(labels) - 1))]
    return out + [(host + "/" + "/".join(segs[:k]), k, len(labels)) for k in range(1, len(segs) + 1)]


def brute(captures, entries):
    out = []
    for url, at in captures:
        active = []
        for pattern, seg, labels in covers(url):
            past = [(e[2], RANK[e[1]], e[1]) for e in entries if None not in e and at is not None and e[0] == pattern and e[2] <= at]
            if past and max(past)[2] != "remove":
                active.append((seg, labels, max(past)[2], pattern, max(past)[0]))
        best = max(active) if active else (0, 0, "none", None, None)
        out.append((url, at, best[2], best[3], best[4], len(active)))
    return sorted(out, key=str)


def judged(spark, captures, entries):
    c = spark.createDataFrame(captures, "url string, fetched_at timestamp").selectExpr("*", "1 as decision", "2 as month", "3 as host")
    e = spark.createDataFrame(entries, "pattern string, action string, listed_at timestamp")
    return sorted(((r["url"], r["fetched_at"], r["decision"], r["pattern"], r["valid_from"], r["n_active"]) for r in url_lists.judge(c, e).collect()), key=str)


ENTRIES = [("example.com", "block", t(10)), ("example.com", "remove", t(40)), ("example.com", "block", t(90)),
           ("a.example.com", "allow", t(20)), ("a.example.com/x", "block", t(30)), ("a.example.com/x/y", "allow", t(35)),
           ("b.org", "allow", t(5)), ("b.org", "block", t(5)), ("b.org", "remove", t(5)), (None, "block", t(1)),
           ("c.net", None, t(1)), ("c.net", "block", None), ("d.net", "block", t(400))]
URLS = ["http://example.com/", "https://A.Example.com/x?q=1", "http://a.example.com/x/y/z#f", "http://user@a.example.com:80/q", "http://b.org",
        "http://c.net/", "http://d.net/", "not a url", "", None, "http://x.y.example.com//x", "http://localhost/a", "http://a.example.com/" + "p/" * 2000]


def test_every_capture_against_the_entries_of_its_time(spark):
    captures = [(u, t(d, 12)) for u in URLS for d in (0, 5, 10, 25, 32, 36, 50, 95, 370)] + [(u, t(d)) for u in URLS[:3] for d in (10, 40)]
    captures += [(URLS[0], t(15)), (URLS[0], t(15)), (URLS[0], None)]
    assert judged(spark, captures, ENTRIES) == brute(captures, ENTRIES)


def test_single_labels_and_case_of_the_host(spark):
    captures = [(u, t(20)) for u in ("http://a.b.gov/x", "http://www.Example.com/P/q", "http://localhost/a")]
    entries = [("gov", "block", t(1)), ("Example.COM", "allow", t(1)), ("WWW.example.com/P", "block", t(2)), ("www.example.com/p", "allow", t(3)), ("localhost", "block", t(1))]
    found = {u: (d, p, n) for u, _, d, p, _, n in judged(spark, captures, entries)}
    assert found == {"http://a.b.gov/x": ("block", "gov", 1), "http://www.Example.com/P/q": ("block", "www.example.com/P", 2),
                     "http://localhost/a": ("block", "localhost", 1)}


def test_empty_tables(spark):
    assert judged(spark, [], ENTRIES) == []
    captures = [(u, t(1)) for u in URLS]
    assert judged(spark, captures, []) == brute(captures, [])


def test_no_python_in_the_plan(spark):
    plan = queries.op3_url_lists(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_on_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    entries = [tuple(r) for r in url_lists.list_of(pages).collect()]
    captures = [(r["url"], r["fetched_at"]) for r in url_lists.captures_of(pages).collect()]
    found = queries.op3_url_lists(spark, SF).collect()
    assert sorted(((r["url"], r["fetched_at"], r["decision"], r["pattern"], r["valid_from"], r["n_active"]) for r in found), key=str) == brute(captures, entries)
    assert {"block", "none"} <= {r["decision"] for r in found}
