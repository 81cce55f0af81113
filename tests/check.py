"""Run registered queries next to their check SQL: python tests/check.py [sf_dir] [key ...]."""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

import __spark_entry__ as contract
from tidemark import session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = []
    for row in rows:
        out.append(tuple(repr(row[i]) for i in order))
    return sorted(out)


def compare(spark, con, sf_dir: str, key: str, fn, sql: str | None):
    """(problem or None, rows)"""
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return None, len(got)
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}", len(got)
    if want:
        odd = [c for c, v in zip(columns, zip(*want))
               if any(isinstance(x, (decimal.Decimal, datetime.date, datetime.timedelta)) for x in v)]
        if odd:
            return f"uncast check columns {odd}", len(got)
    a, b = canonical(got, df.columns), canonical(want, columns)
    if a != b:
        in_a, in_b = set(a), set(b)
        only_a = [x for x in a if x not in in_b][:2]
        only_b = [x for x in b if x not in in_a][:2]
        return f"rows {len(a)} vs {len(b)}; columns {sorted(columns)}\n   spark {only_a}\n   check {only_b}", len(got)
    return None, len(got)


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    queries, oracle = contract.queries(), contract.oracle_sql()
    keys = [k for k in queries if not args or any(k == a or (a.endswith("*") and k.startswith(a[:-1])) for a in args)]
    spark = session.build("check", "local[8]", 8, {"spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for key in keys:
        start = time.time()
        try:
            problem, n = compare(spark, con, sf_dir, key, queries[key], oracle.get(key))
        except Exception as e:  # one failing query must not hide the others
            problem, n = f"{type(e).__name__}: {str(e)[:700]}", -1
        mark = "ok  " if problem is None else "BAD "
        if problem is None and n == 0:
            mark = "zero"
        bad += problem is not None
        print(f"{mark} {key} rows={n} {'' if key in oracle else '(rows only) '}{time.time() - start:.1f}s"
              + (f"\n   {problem}" if problem else ""), flush=True)
    print(f"{len(keys)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
