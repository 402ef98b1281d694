"""Runs queries beside their SQL in DuckDB and compares the rows, as sets with floats rounded."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, dict):
        return tuple((k, norm(x)) for k, x in v.items())
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def compare(spark, con, folder: str, query, sql: str) -> str:
    """'' where both give the same rows, else what differs."""
    df = query(spark, folder)
    mine = df.collect()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    order = sorted(names)
    a = Counter(tuple(norm(r[c]) for c in order) for r in mine)
    at = [names.index(c) for c in order]
    b = Counter(tuple(norm(r[i]) for i in at) for r in theirs)
    if a == b:
        return "" if mine else "no rows"
    only_a, only_b = list((a - b).elements()), list((b - a).elements())
    by = lambda rows: [str(x)[:700] for x in sorted(rows, key=str)[:2]]
    return f"{len(mine)} and {len(theirs)} rows, {len(only_a)} and {len(only_b)} differ\n  {order}\n  spark {by(only_a)}\n  duckdb {by(only_b)}"
