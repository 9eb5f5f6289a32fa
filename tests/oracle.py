"""Compare a Spark result with DuckDB's result of the oracle SQL."""

from __future__ import annotations

import os

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value))
    if isinstance(value, pd.Timestamp) or hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return str(value)


def _rows(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    table = [[_cell(v) for v in frame[c].astype(object)] for c in columns]
    return sorted(zip(*table), key=repr) if table else []


def compare(spark_frame, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    got, want = spark_frame.toPandas(), con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    left, right = _rows(got), _rows(want)
    for a, b in zip(left, right):
        if a != b:
            names = sorted(got.columns)
            return str([(n, x, y) for n, x, y in zip(names, a, b) if x != y])
    return None
