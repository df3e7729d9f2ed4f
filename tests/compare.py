"""Row-by-row comparison of a DataFrame with DuckDB over the same tables."""

from __future__ import annotations

import glob
import os
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if v != v else round(v, 9) + 0.0
    if isinstance(v, Decimal):
        return round(float(v), 9)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return v


def rows_of(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(plain(r[i]) for i in order)) for r in rows)


def duck(sql: str, folder: str) -> tuple[list[str], list]:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        if os.path.exists(path):
            files = sorted(glob.glob(f"{path}/*.parquet")) if os.path.isdir(path) else [path]
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet({files!r})")
    got = con.execute(sql)
    return [d[0] for d in got.description], got.fetchall()


def assert_same(df, sql: str, folder: str) -> int:
    columns, expected = duck(sql, folder)
    assert sorted(df.columns) == sorted(columns)
    actual = [tuple(r) for r in df.collect()]
    a, b = rows_of(df.columns, actual), rows_of(columns, expected)
    if a != b:
        here, there = Counter(a), Counter(b)
        extra, missing = list((here - there).elements())[:3], list((there - here).elements())[:3]
        raise AssertionError(f"{len(a)} rows against {len(b)}; only here: {extra}; only there: {missing}")
    return len(a)
