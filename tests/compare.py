"""Run a registered query and its SQL over the same tables and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, name, build, sql, folder, con) -> tuple[int, int]:
    """Raise if names, types or rows differ; returns the row count and the number of columns."""
    frame = build(spark, folder)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(frame.columns) == sorted(names), (name, frame.columns, names)
    expected = cursor.fetchall()
    got = frame.collect()
    left, right = rows_of(frame.columns, got), rows_of(names, expected)
    only_spark, only_sql = left - right, right - left
    assert left == right, (
        f"{name}: {len(got)} against {len(expected)} rows; only in Spark {list(only_spark.items())[:3]}, "
        f"only in SQL {list(only_sql.items())[:3]}"
    )
    for column in frame.columns:
        a = next((r[column] for r in got if r[column] is not None), None)
        b = next((r[names.index(column)] for r in expected if r[names.index(column)] is not None), None)
        assert type(a) is type(b), f"{name}.{column}: {type(a)} against {type(b)}"
    return len(got), len(names)
