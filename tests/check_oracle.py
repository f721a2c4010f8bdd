"""Compare every registered query with its DuckDB twin: python tests/check_oracle.py [sf] [name ...]."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry_module  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, sf_dir, name, fn, sql):
    started = time.time()
    df = fn(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    spark_s = time.time() - started
    if sql is None:
        return f"rows-only {len(rows):>7}  {spark_s:6.2f}s", True
    cur = con.execute(sql)
    duck_cols = [d[0] for d in cur.description]
    a = normalised(df.columns, rows)
    b = normalised(duck_cols, cur.fetchall())
    if a == b:
        return f"match     {len(rows):>7}  {spark_s:6.2f}s", True
    if a[0] != b[0]:
        return f"COLUMNS differ {a[0]} {b[0]}", False
    bad = [(x, y) for x, y in zip(a[1], b[1]) if x != y]
    return f"DIFF rows {len(a[1])} vs {len(b[1])}; {len(bad)} differ; first {bad[:1]} cols {a[0]}", False


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    from conftest import make_session

    spark = make_session()
    con = duck(sf_dir)
    queries, sqls = entry_module.queries(), entry_module.oracle_sql()
    failed = 0
    for name, fn in queries.items():
        if wanted and name not in wanted:
            continue
        try:
            text, ok = compare(spark, con, sf_dir, name, fn, sqls.get(name))
        except Exception as exc:  # report and go on with the next query
            text, ok = f"ERROR {type(exc).__name__}: {str(exc)[:1500]}", False
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:<32} {text}", flush=True)
    print(f"{failed} failed")
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main()
