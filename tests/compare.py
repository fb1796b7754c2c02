"""Run registered queries next to their SQL and compare rows exactly."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, float):
        return (2, repr(v + 0.0))
    if isinstance(v, dt.datetime):
        return (3, v.isoformat())
    return (4, f"{type(v).__name__}:{v}")


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    result = con.execute(sql)
    return rows_of([d[0] for d in result.description], result.fetchall())


def difference(got, want) -> str | None:
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        a, b = set(got[1]), set(want[1])
        return f"rows {len(got[1])} vs {len(want[1])}; only spark {list(a - b)[:2]}; only sql {list(b - a)[:2]}"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from callpay.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = spark_rows(fn(spark, sf_dir))
            problem = difference(got, duck_rows(con, sqls[name])) if name in sqls else None
            n = len(got[1])
        except Exception as e:  # report and go on
            problem, n = f"{type(e).__name__}: {str(e)[:600]}", -1
        bad += problem is not None
        state = "FAIL" if problem else ("ok" if name in sqls else "rows")
        print(f"{state:5}{time.time() - start:6.2f}s {n:7} {name} {problem or ''}", flush=True)
    print("failed:", bad)
