"""Run a registered query in Spark and its DuckDB oracle; compare like the driver.

Checks row count, column names and an order-insensitive hash of the values.
Usable from pytest and as a script: ``python tests/oracle_harness.py [names]``.
"""

from __future__ import annotations

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
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, name: str, sf_dir: str, con=None):
    import __spark_entry__ as E

    t0 = time.time()
    sdf = E.queries()[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    con = con or duck(sf_dir)
    res = con.execute(E.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={s_cols} duck={d_cols}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    if not problems:
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, first: {diff}")
    return {"name": name, "rows": len(s_rows), "ok": not problems, "problems": problems,
            "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}


if __name__ == "__main__":
    from airwave.session import get_session
    import __spark_entry__ as E

    sf = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
    spark = get_session("oracle-check", master="local[8]", shuffle_partitions=8)
    names = sys.argv[1:] or [n for n in E.queries() if n in E.oracle_sql()]
    con = duck(sf)
    bad = 0
    for n in names:
        r = compare(spark, n, sf, con)
        bad += not r["ok"]
        print(("OK  " if r["ok"] else "BAD ") + f"{n:28s} rows={r['rows']:<7} spark={r['spark_s']}s duck={r['duck_s']}s",
              "" if r["ok"] else r["problems"], flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
