"""Compare a registered Spark query with its DuckDB oracle.

Mirrors the driver's gate: same row count, same column names, and the same
multiset of rows once columns are sorted by name and doubles rounded.
Run as a script to check every query: ``python tests/oracle_harness.py [sf_dir] [name...]``.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, name: str, sf_dir: str):
    import __spark_entry__ as E
    t0 = time.time()
    df = E.queries()[name](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t_spark = time.time() - t0
    sql = E.oracle_sql().get(name)
    if sql is None:
        return {"name": name, "ok": None, "rows": len(s_rows), "spark_s": round(t_spark, 2)}
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={sorted(s_cols)} duck={sorted(d_cols)}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    if not problems:
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, e.g. {diff}")
    return {"name": name, "ok": not problems, "rows": len(s_rows),
            "spark_s": round(t_spark, 2), "problems": problems}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from tidemark.session import get_session
    import __spark_entry__ as E
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for name in names or list(E.queries()):
        try:
            r = compare(spark, con, name, sf_dir)
        except Exception as exc:  # report and continue
            r = {"name": name, "ok": False, "problems": [f"{type(exc).__name__}: {str(exc)[:400]}"]}
        bad += r["ok"] is False
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
