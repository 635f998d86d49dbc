"""Run registered queries in Spark and their SQL oracle in DuckDB; compare rows, columns and values.

usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import hashlib
import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "None"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, Decimal):
        return str(v.normalize())
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    hs, ls = digest(scols, srows)
    hd, ld = digest(dcols, drows)
    ok = sorted(scols) == sorted(dcols) and len(srows) == len(drows) and hs == hd
    print(f"{name:28s} {'OK ' if ok else 'BAD'} spark={len(srows)} duck={len(drows)} {t1 - t0:.1f}s", flush=True)
    if not ok:
        if sorted(scols) != sorted(dcols):
            print("   cols", sorted(scols), sorted(dcols))
        a, b = set(ls), set(ld)
        for x in list(a - b)[:3]:
            print("   spark only:", x)
        for x in list(b - a)[:3]:
            print("   duck  only:", x)
    return ok


def main():
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from bourse.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session()
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    bad = []
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if name not in oracle:
            df = fn(spark, sf_dir)
            print(f"{name:28s} (no oracle) rows={df.count()}")
            continue
        if not compare(spark, con, name, fn, oracle[name], sf_dir):
            bad.append(name)
    print("FAILED:", bad if bad else "none")


if __name__ == "__main__":
    main()
