"""Compare a registered query with its SQL: same columns, same rows, whatever the order."""

from __future__ import annotations

import os

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        column = frame[name]
        if pd.api.types.is_datetime64_any_dtype(column):
            frame[name] = column.dt.tz_localize(None).astype("datetime64[us]")
        elif pd.api.types.is_bool_dtype(column):
            pass
        elif pd.api.types.is_integer_dtype(column):
            frame[name] = column.astype("int64")
        elif pd.api.types.is_float_dtype(column):
            frame[name] = column.astype("float64") + 0.0
        else:
            frame[name] = column.astype(object)
    return frame.sort_values(list(frame.columns), ignore_index=True)


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} != {len(sql_frame)}"
    left, right = normal(spark_frame), normal(sql_frame)
    try:
        pd.testing.assert_frame_equal(left, right, check_exact=True, check_column_type=False)
    except AssertionError as error:
        return str(error)
    return None
