"""Comparison of a query with its oracle SQL in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for p in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def same(spark, build, sql: str, sf_dir: str) -> int:
    """Assert that both give the same rows under the same names; return their number."""
    df = build(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    rel = views(sf_dir).sql(sql)
    want = rows(rel.columns, rel.fetchall())
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(got) == len(want), (len(got), len(want))
    diff = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    assert not diff, diff[:3]
    return len(got)
