"""Side-by-side comparison of a Spark query with its DuckDB SQL."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _normal(value):
    if isinstance(value, float):
        return round(value, 9)
    return value


def _key(row):
    return tuple((value is None, str(type(value)), str(value)) for value in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(_normal(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=_key)


def compare(spark_df, con, sql: str) -> str | None:
    """None when both sides agree, else a short description of the difference."""
    left = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    right = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} rows != {len(right[1])}"
    wrong = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    if wrong:
        a, b = wrong[0]
        diff = [(c, x, y) for c, x, y in zip(left[0], a, b) if x != y][:2]
        return f"{len(wrong)} of {len(left[1])} rows differ, first: {str(diff)[:600]}"
    return None
