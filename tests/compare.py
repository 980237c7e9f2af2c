"""Compare a Spark result with the DuckDB result of the matching SQL by value."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows by value."""
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns), na_position="last").reset_index(drop=True)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} and {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"{len(spark_frame)} and {len(sql_frame)} rows"
    left, right = canonical(spark_frame), canonical(sql_frame)
    for name in left.columns:
        a, b = left[name], right[name]
        same = (a == b) | (a.isna() & b.isna())
        if not same.all():
            at = same.idxmin()
            return f"{(~same).sum()} values of {name}, first {a[at]!r} and {b[at]!r}"
    return None
