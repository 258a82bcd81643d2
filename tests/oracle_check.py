"""Run catalog queries on Spark and their SQL on DuckDB and compare the results.

``python tests/oracle_check.py <folder> [query ...]`` prints one line per query.
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(folder: str):
    con = duckdb.connect()
    for f in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(f)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{f}'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


def compare(spark, con, folder: str, name: str) -> str:
    import __spark_entry__ as e

    df = e.queries()[name](spark, folder)
    mine = canonical(df.columns, [tuple(r) for r in df.collect()])
    sql = e.oracle_sql().get(name)
    if sql is None:
        return f"rows={len(mine)} no SQL"
    rel = con.execute(sql)
    columns = [d[0] for d in rel.description]
    theirs = canonical(columns, rel.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"COLUMNS {df.columns} {columns}"
    if mine != theirs:
        diff = next(((a, b) for a, b in zip(mine, theirs) if a != b), ("", ""))
        return f"DIFFERENT rows {len(mine)} {len(theirs)}: {str(diff[0])[:200]} | {str(diff[1])[:200]}"
    return f"ok rows={len(mine)}"


if __name__ == "__main__":
    import __spark_entry__ as e
    from lexmill.session import build_session

    data, wanted = sys.argv[1], sys.argv[2:] or list(e.queries())
    session, db = build_session("8"), connect(data)
    for q in wanted:
        t = time.time()
        try:
            result = compare(session, db, data, q)
        except Exception as x:
            result = f"FAIL {type(x).__name__} {str(x)[:600]}"
        print(f"{q:20s} {time.time() - t:6.2f}s {result}", flush=True)
