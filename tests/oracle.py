"""Compare a query with its SQL twin: names, row counts and values."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _sorted_rows(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in at) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(v)) for v in row))


def difference(df, con, sql: str) -> str | None:
    """None when equal, else what differs first."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = _sorted_rows(names, result.fetchall())
    ours = _sorted_rows(df.columns, [tuple(row) for row in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows and {len(theirs)}"
    for mine, other in zip(ours, theirs):
        if mine != other:
            return f"{str(mine)[:400]} and {str(other)[:400]}"
    return None
