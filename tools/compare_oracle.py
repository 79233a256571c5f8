"""Run every registered query in Spark and its oracle SQL in DuckDB on the same
parquet folder and compare row count, column names and an order-insensitive
hash of the values.

    python tools/compare_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from retail_lakehouse import registry  # noqa: E402
from retail_lakehouse.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (dt.date, dt.time)):
        return v.isoformat()
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = build_session("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    q, o = registry.queries(), registry.oracle_sql()
    results = {}
    bad = 0
    for name, fn in q.items():
        if only and name not in only:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        if name not in o:
            results[name] = {"rows": len(s_rows), "oracle": None}
            print(f"{name:40s} spark rows={len(s_rows)} (no oracle) {t1 - t0:.1f}s")
            continue
        cur = con.execute(o[name])
        d_cols = [c[0] for c in cur.description]
        d_rows = cur.fetchall()
        sh, sl = digest(s_cols, s_rows)
        dh, dl = digest(d_cols, d_rows)
        ok = sorted(s_cols) == sorted(d_cols) and len(s_rows) == len(d_rows) and sh == dh
        bad += not ok
        results[name] = {"ok": ok, "rows": len(s_rows), "oracle_rows": len(d_rows)}
        print(f"{name:40s} {'OK ' if ok else 'BAD'} rows={len(s_rows)}/{len(d_rows)} {t1 - t0:.1f}s")
        if not ok:
            if sorted(s_cols) != sorted(d_cols):
                print("   cols spark:", s_cols, "\n   cols duck :", d_cols)
            diff_s = sorted(set(sl) - set(dl))[:3]
            diff_d = sorted(set(dl) - set(sl))[:3]
            print("   cols:", sorted(s_cols))
            for a in diff_s:
                print("   spark only:", a[:400])
            for b in diff_d:
                print("   duck only :", b[:400])
    print(json.dumps({"bad": bad, "n": len(results)}))
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
