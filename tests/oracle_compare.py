"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
Compares row count, column names and an order-insensitive multiset of
normalised rows (columns sorted by name), like the driver's check.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    con.execute("SET TimeZone='UTC'")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as e
    qs, sqls = e.queries(), e.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            rows = df.collect()
            cols = df.columns
        except Exception as exc:  # report and go on with the next query
            results[name] = {"error": str(exc).splitlines()[0][:300], "match": False}
            if verbose:
                print(f"{name:40s} ERROR {results[name]['error']}", flush=True)
            continue
        spark_s = time.time() - t0
        if name not in sqls:
            results[name] = {"rows": len(rows), "oracle": None}
            if verbose:
                print(f"{name:40s} rows={len(rows):7d} (no oracle) {spark_s:.1f}s", flush=True)
            continue
        cur = con.execute(sqls[name])
        ocols = [d[0] for d in cur.description]
        orows = cur.fetchall()
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
        a = Counter(tuple(norm(r[i]) for i in order) for r in rows)
        b = Counter(tuple(norm(r[i]) for i in oorder) for r in orows)
        ok = (len(rows) == len(orows) and sorted(cols) == sorted(ocols) and a == b)
        results[name] = {"rows": len(rows), "oracle_rows": len(orows), "match": ok}
        if verbose:
            print(f"{name:40s} rows={len(rows):7d} oracle={len(orows):7d} "
                  f"{'OK' if ok else 'MISMATCH'} {spark_s:.1f}s", flush=True)
            if not ok:
                print("   spark cols", cols, "\n   oracle cols", ocols)
                print("   spark-only", list((a - b).items())[:3])
                print("   oracle-only", list((b - a).items())[:3])
    return results


if __name__ == "__main__":
    args = sys.argv[1:]
    plain = "--plain" in args  # a bare session, like the driver's
    args = [a for a in args if a != "--plain"]
    sf = args[0] if args else "/root/testdata/sf0.01"
    if plain:
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
                 .config("spark.ui.enabled", "false").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        from changefold.session import build_session
        spark = build_session(shuffle_partitions=8)
    res = compare(spark, sf, args[1:] or None)
    bad = [k for k, v in res.items() if v.get("match") is False]
    print("MISMATCHES:", bad)
