"""Run registered queries next to their SQL on DuckDB and compare the rows."""

from __future__ import annotations

import datetime
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{sf}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return int(v) if v == int(v) and abs(v) < 1e15 else v
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: str(r))


def compare(df, con, sql: str) -> list[str]:
    """Differences between a DataFrame and a SQL result, as messages."""
    spark_cols, spark_rows = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    duck_cols, duck_rows = rows_of(names, cur.fetchall())
    problems = []
    if spark_cols != duck_cols:
        problems.append(f"columns: {spark_cols} / {duck_cols}")
        return problems
    if len(spark_rows) != len(duck_rows):
        problems.append(f"rows: {len(spark_rows)} / {len(duck_rows)}")
    if not spark_rows:
        problems.append("no rows")
    a, b = {}, {}
    for r in spark_rows:
        a[r] = a.get(r, 0) + 1
    for r in duck_rows:
        b[r] = b.get(r, 0) + 1
    only_a = [r for r in a if a[r] != b.get(r, 0)]
    only_b = [r for r in b if b[r] != a.get(r, 0)]
    if only_a or only_b:
        problems.append(f"{len(only_a)}/{len(only_b)} rows differ")
        for r in only_a[:3]:
            near = max(only_b, key=lambda q: sum(x == y for x, y in zip(r, q)), default=None)
            if near is not None:
                diff = [(c, x, y) for c, x, y in zip(spark_cols, r, near) if x != y]
                problems.append(f"   {diff}")
            else:
                problems.append(f"   only spark: {r}")
    return problems
