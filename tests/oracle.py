"""Compare registered queries with their SQL on DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def mismatch(spark, con, name: str, fn, sql: str, sf: str) -> str | None:
    """None when both sides agree, else a short description."""
    df = fn(spark, sf)
    got = canonical(df.columns, df.collect())
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want = canonical(names, rel.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"{name}: columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{name}: {len(got)} rows, expected {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        return f"{name}: {len(bad)} rows differ, first {bad[0]}"
    return None
