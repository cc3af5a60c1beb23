"""Compare a registered query with its SQL twin on the same Parquet tables."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}") + 0.0
    if isinstance(value, dict):
        return tuple((k, _plain(v)) for k, v in sorted(value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _order(row):
    return tuple((v is not None, str(type(v)), str(v)) for v in row)


def compare(df, sql: str, con) -> tuple[int, list]:
    """Number of rows and the first differences (empty when equal)."""
    columns = sorted(df.columns)
    found = sorted((tuple(_plain(r[c]) for c in columns) for r in (x.asDict(True) for x in df.collect())), key=_order)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns, (sorted(names), columns)
    expected = sorted((tuple(_plain(dict(zip(names, r))[c]) for c in columns) for r in cursor.fetchall()), key=_order)
    if len(found) != len(expected):
        return len(found), [("rows", len(found), len(expected)), found[:3], expected[:3]]
    return len(found), [(columns, f, e) for f, e in zip(found, expected) if f != e][:3]
