"""Spark rows against DuckDB rows, as sets of normalised tuples."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir: str):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


def value(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x)
    if isinstance(x, list):
        return tuple(map(value, x))
    return x


def compared(df, c, sql: str) -> tuple[Counter, Counter]:
    found = c.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    expected = Counter(tuple(value(r[names.index(n)]) for n in order) for r in found.fetchall())
    got = Counter(tuple(value(r[n]) for n in order) for r in df.collect())
    return got, expected
