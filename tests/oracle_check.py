"""Run queries beside their SQL twins and compare names, counts and values.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (list, tuple)):
        return tuple(_cell(x) for x in v)
    return str(v) if not isinstance(v, int) else v


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(df, con, sql: str) -> str:
    left_cols, left = _sorted(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    right_cols, right = _sorted([d[0] for d in cur.description], cur.fetchall())
    if left_cols != right_cols:
        return f"columns {left_cols} vs {right_cols}"
    if len(left) != len(right):
        return f"rows {len(left)} vs {len(right)}"
    if not left:
        return "no rows"
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        return f"{len(bad)} of {len(left)} rows differ: {bad[0][0]} vs {bad[0][1]}"
    return ""


def main() -> int:
    import __spark_entry__ as entry
    from rarespark.session import local_session

    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.01"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = args[1:] or list(queries)
    failed = 0
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, sf)
            if name in oracles:
                problem = compare(df, con, oracles[name])
            else:
                n = df.count()
                problem = "" if n else "no rows"
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        took = time.time() - start
        failed += bool(problem)
        kind = "S" if name in oracles else "R"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name} {took:.1f}s {problem}", flush=True)
    print(f"{len(names) - failed}/{len(names)} ok")
    return failed


if __name__ == "__main__":
    sys.exit(main())
