"""Compare registered Spark queries with their DuckDB twins.

Mimics the driver's gate: row count, column names and an order-insensitive
comparison of the values (doubles already rounded to 6 decimals on both sides).
Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, round(v, 6) + 0.0)
    if isinstance(v, bool):
        return (3, int(v))
    if isinstance(v, int):
        return (2, float(v))
    return (4, str(v))


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows), [cols[i] for i in order]


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    scols = sdf.columns
    if sql is None:
        return dict(name=name, ok=None, rows=len(srows), spark_s=round(t1 - t0, 2))
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    a, ac = rows_of(scols, srows)
    b, bc = rows_of(dcols, drows)
    ok = ac == bc and len(a) == len(b) and a == b
    detail = ""
    if ac != bc:
        detail = f"cols {ac} vs {bc}"
    elif len(a) != len(b):
        detail = f"rows {len(a)} vs {len(b)}"
    elif a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        detail = f"{len(bad)} differ, e.g. {bad[:2]}"
    return dict(name=name, ok=ok, rows=len(srows), spark_s=round(t1 - t0, 2), detail=detail)


def main(argv):
    sf_dir = "/root/testdata/sf0.01"
    names = []
    for a in argv:
        if os.path.isdir(a):
            sf_dir = a
        else:
            names.append(a)
    import __spark_entry__ as E
    from pulsegrid.session import get_spark
    spark = get_spark("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(qs):
        try:
            r = compare(spark, con, name, qs[name], sqls.get(name), sf_dir)
        except Exception as exc:  # report and continue
            r = dict(name=name, ok=False, detail=f"{type(exc).__name__}: {str(exc)[:300]}")
        bad += r["ok"] is False
        print(("OK  " if r["ok"] else ("ROWS" if r["ok"] is None else "FAIL")), r, flush=True)
    print(f"failed: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
