"""Spark-vs-DuckDB comparison of the registered queries (the correctness gate, locally).

Usage: python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, int):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, dict):
        return tuple(sorted((str(k), norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return str(v)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)
    return cols, out


def compare_one(spark, con, name, builder, sql, sf_dir):
    t0 = time.time()
    df = builder(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    sc, sr = canon(scols, srows)
    dc, dr = canon(dcols, drows)
    ok = sc == dc and sr == dr
    detail = ""
    if not ok:
        if sc != dc:
            detail = f"columns spark={sc} duck={dc}"
        elif len(sr) != len(dr):
            detail = f"rows spark={len(sr)} duck={len(dr)}"
        else:
            diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
            detail = f"values differ e.g. {diff}"
    return ok, len(srows), t1 - t0, detail


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as E
    from tidemark.session import build_session

    spark = build_session(master="local[8]", extra={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for name, builder in qs.items():
        if only and name not in only:
            continue
        if name not in oracle:
            n = builder(spark, sf_dir).count()
            print(f"{name:28s} NO-ORACLE rows={n}")
            continue
        try:
            ok, n, secs, detail = compare_one(spark, con, name, builder, oracle[name], sf_dir)
        except Exception as exc:  # report and go on
            ok, n, secs, detail = False, -1, 0.0, f"error {type(exc).__name__}: {str(exc)[:400]}"
        bad += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} rows={n:6d} {secs:6.2f}s {detail}")
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
