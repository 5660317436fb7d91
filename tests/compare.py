"""Run named queries on Spark and their SQL twins on DuckDB and compare the rows.

    python tests/compare.py [sf] [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time
from fnmatch import fnmatch

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TESTDATA = "/root/testdata"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(x):
    if hasattr(x, "asDict"):
        return str({k: _cell(v) for k, v in sorted(x.asDict().items())})
    if isinstance(x, dict):
        return str({k: _cell(v) for k, v in sorted(x.items())})
    if isinstance(x, (list, tuple)):
        return str([_cell(v) for v in x])
    if isinstance(x, float):
        return repr(0.0 if x == 0 else x)
    return repr(x) if isinstance(x, str) else str(x)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir: str, name: str, fn, sql: str | None):
    """(ok, message, seconds)"""
    started = time.time()
    df = fn(spark, sf_dir)
    got_cols, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    seconds = time.time() - started
    if sql is None:
        return (len(got) > 0, f"{len(got)} rows, no SQL", seconds)
    cursor = duck(sf_dir).execute(sql)
    want_cols, want = canonical([d[0] for d in cursor.description], cursor.fetchall())
    if got_cols != want_cols:
        return False, f"columns {got_cols} != {want_cols}", seconds
    if len(got) != len(want):
        return False, f"{len(got)} rows != {len(want)}", seconds
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return False, f"{len(bad)} of {len(got)} rows differ, first: {str(bad[0][0])[:400]} != {str(bad[0][1])[:400]}", seconds
    return True, f"{len(got)} rows agree", seconds


def main() -> None:
    import __spark_entry__ as entry
    from postloom.session import local_session

    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0][0].isdigit() else "0.01"
    sf_dir = f"{TESTDATA}/sf{sf}"
    spark = local_session(8)
    queries, sqls = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not args or any(fnmatch(n, a) for a in args)]
    failed = 0
    for name in names:
        try:
            ok, message, seconds = compare(spark, sf_dir, name, queries[name], sqls.get(name))
        except Exception as e:  # noqa: BLE001
            ok, message, seconds = False, f"{type(e).__name__}: {str(e)[:900]}", 0.0
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {seconds:6.2f}s {name}: {message}", flush=True)
    print(f"{len(names) - failed} of {len(names)} ok; {sum(n in sqls for n in names)} with SQL")


if __name__ == "__main__":
    main()
