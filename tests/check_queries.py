"""Runs registered queries in Spark and their SQL in DuckDB and compares rows. Usage: check_queries.py SF_DIR [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def duckdb_on(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, name: str, df=None) -> str | None:
    """None when equal, else what differs."""
    df = entry.queries()[name](spark, sf_dir) if df is None else df
    mine = df.collect()
    text = entry.oracle_sql().get(name)
    if text is None:
        return None if mine else "no rows"
    result = con.sql(text)
    kinds = dict(zip(result.columns, map(str, result.types)))
    if sorted(df.columns) != sorted(kinds):
        return f"columns differ: {sorted(set(df.columns) ^ set(kinds))}"
    wrong = [(c, t, kinds[c]) for c, t in df.dtypes if KINDS.get(t) != kinds[c]]
    a, b = _rows(df.columns, mine), _rows(result.columns, result.fetchall())
    if len(a) != len(b):
        return f"{len(a)} rows, expected {len(b)} {wrong}"
    off = [i for i, (x, y) in enumerate(zip(a, b)) if x != y]
    if off:
        names = sorted(df.columns)
        pairs = [(n, p, q) for n, p, q in zip(names, a[off[0]], b[off[0]]) if p != q]
        return f"{len(off)} of {len(a)} rows differ, first in {pairs[:6]} {wrong}"
    if wrong:
        return f"types differ: {wrong}"
    return None if a else "no rows"


if __name__ == "__main__":
    from session import local_session

    spark, sf_dir = local_session(), sys.argv[1]
    con = duckdb_on(sf_dir)
    failed = []
    for name in sys.argv[2:] or entry.queries():
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    sys.exit(bool(failed))
