"""Compare queries with their SQL: python tests/compare.py [--sf DIR] NAME..."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.master("local[8]").config(map={
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false",
    }).getOrCreate()


def database(d: str):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for p in glob.glob(f"{d}/*.parquet"):
        files = f"{p}/*.parquet" if os.path.isdir(p) else p
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{files}')")
    return con


def norm(x):
    if isinstance(x, float):
        return "nan" if x != x else repr(round(x, 6) + 0.0)
    if isinstance(x, (list, tuple)):
        return tuple(norm(y) for y in x)
    if isinstance(x, dict):
        return tuple(sorted((k, norm(v)) for k, v in x.items()))
    if hasattr(x, "asDict"):
        return norm(x.asDict())
    return x if x is None or isinstance(x, (str, bytes, bool)) else str(x)


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)


def rows_of_sql(con, sql):
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in cur.fetchall()), key=repr)


def main(args):
    import __spark_entry__ as e

    d = "/root/testdata/sf0.01"
    if args[:1] == ["--sf"]:
        d, args = args[1], args[2:]
    spark, con = session(), database(d)
    spark.sparkContext.setLogLevel("ERROR")
    q, o = e.queries(), e.oracle_sql()
    names = [n for n in q if not args or n in args or any(a.endswith("*") and n.startswith(a[:-1]) for a in args)]
    bad = []
    for n in names:
        t = time.time()
        try:
            cols, got = rows_of_spark(q[n](spark, d))
            took = time.time() - t
            if n not in o:
                print(f"{n}: {len(got)} rows, no SQL, {took:.1f} s", flush=True)
                continue
            t = time.time()
            want_cols, want = rows_of_sql(con, o[n])
            same = cols == want_cols and got == want
            print(f"{n}: {'ok' if same else 'DIFFERS'} {len(got)} rows, {took:.1f} s, SQL {time.time() - t:.1f} s", flush=True)
            if not same:
                bad.append(n)
                print("  columns", cols, want_cols)
                a, b = set(got), set(want)
                print("  only Spark", len(a - b), list(a - b)[:3])
                print("  only SQL", len(b - a), list(b - a)[:3])
        except Exception as x:
            bad.append(n)
            print(f"{n}: ERROR {type(x).__name__} {str(x)[:600]}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
