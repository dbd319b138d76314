"""Compare a Spark result with DuckDB's as sorted rows under sorted column names."""

from __future__ import annotations

import datetime
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def _value(value):
    if isinstance(value, float) and math.isnan(value):
        return ("nan",)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _key(row):
    return tuple((v is None, type(v).__name__, str(v)) for v in row)


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=_key)


def spark_rows(df):
    return _sorted(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(db, sql):
    cursor = db.execute(sql)
    return _sorted([d[0] for d in cursor.description], cursor.fetchall())


def differences(left, right, limit=3):
    """Empty when both results are equal."""
    if left[0] != right[0]:
        return [f"columns {left[0]} / {right[0]}"]
    if len(left[1]) != len(right[1]):
        return [f"{len(left[1])} / {len(right[1])} rows"]
    unlike = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    kinds = [
        (a, b) for a, b in zip(left[1], right[1]) if [type(x) for x in a] != [type(x) for x in b]
    ]
    return [f"{a} / {b}" for a, b in (unlike + kinds)[:limit]]
