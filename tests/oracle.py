"""Run a query and its SQL on the same Parquet tables and compare rows exactly."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = Path(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if path.is_dir() else ''}')")
    return con


def cell(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return ""
    if isinstance(x, float):
        return repr(round(x, 9) + 0.0)
    if isinstance(x, (list, tuple)):
        return "[" + ",".join(map(cell, x)) + "]"
    return str(x)


def compare(spark, sf_dir: str, query, sql: str) -> str:
    """Empty when equal, else what differs."""
    df = query(spark, sf_dir)
    cols = sorted(df.columns)
    ours = sorted(tuple(map(cell, r)) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    rel = duck(sf_dir).sql(sql)
    if sorted(rel.columns) != cols:
        return f"columns {cols} against {sorted(rel.columns)}"
    theirs = sorted(tuple(map(cell, r)) for r in rel.select(*[f'"{c}"' for c in cols]).fetchall())
    if len(ours) != len(theirs):
        return f"rows {len(ours)} against {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs, strict=True) if a != b]
    return f"{len(bad)} of {len(ours)} rows, first {bad[0]}" if bad else ""
