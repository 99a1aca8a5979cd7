"""Run a registered query and its SQL statement side by side."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    return value


def _bag(rows, order):
    return Counter(tuple((type(r[i]).__name__, _cell(r[i])) for i in order) for r in rows)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What tells the two results apart, or None when they hold the same rows."""
    got = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    common = sorted(names)
    left = _bag(got, [df.columns.index(c) for c in common])
    right = _bag(want, [names.index(c) for c in common])
    if left == right:
        return None
    only_left, only_right = list((left - right).items()), list((right - left).items())
    return (
        f"{len(got)} rows against {len(want)}; {common}\n"
        f"  spark only {len(only_left)}: {only_left[:2]}\n"
        f"  sql only   {len(only_right)}: {only_right[:2]}"
    )
