"""Compares a query with its SQL twin as sorted rows of rounded values."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(_value(r[k]) for k in order) for r in data), key=repr)


def differences(spark, sf_dir: str, query, sql: str) -> tuple[int, list, list]:
    got = query(spark, sf_dir)
    found = connect(sf_dir).execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(got.columns), (sorted(names), sorted(got.columns))
    mine, theirs = rows(got.columns, got.collect()), rows(names, found.fetchall())
    if mine == theirs:
        return len(mine), [], []
    one, two = Counter(mine), Counter(theirs)
    return len(mine), list(one - two)[:3], list(two - one)[:3]
