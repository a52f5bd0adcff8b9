"""Runs each query beside its SQL in DuckDB and compares whole results."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def _cell(value):
    if hasattr(value, "to_pydatetime"):
        value = value.to_pydatetime()
    if hasattr(value, "item"):
        value = value.item()
    if value is None or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return float(f"{float(value):.12g}")
    return value


def rows_of(frame) -> Counter:
    ordered = frame[sorted(frame.columns)]
    columns = [map(_cell, ordered[c].tolist()) for c in ordered.columns]
    return Counter(zip(*columns))


def compare(got, expected) -> str | None:
    """None when equal, else what differs."""
    if sorted(got.columns) != sorted(expected.columns):
        return f"columns {sorted(got.columns)} != {sorted(expected.columns)}"
    left, right = rows_of(got), rows_of(expected)
    if left == right:
        return None
    only_left, only_right = left - right, right - left
    return (
        f"rows {sum(left.values())} vs {sum(right.values())}; "
        f"extra {list(only_left)[:3]}; missing {list(only_right)[:3]}"
    )
