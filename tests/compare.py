"""Run a query on Spark and its SQL on DuckDB and compare the rows as bags."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    def cell(x):
        if x is None or x is pd.NA or (isinstance(x, float) and x != x):
            return None
        if hasattr(x, "item"):
            x = x.item()
        return repr(x) if isinstance(x, float) else x  # tells -0.0 from 0.0
    return sorted((tuple(cell(x) for x in row) for row in df.itertuples(index=False, name=None)),
                  key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def differences(spark_rows: pd.DataFrame, duck_rows: pd.DataFrame) -> str | None:
    if sorted(spark_rows.columns) != sorted(duck_rows.columns):
        return f"columns {sorted(spark_rows.columns)} != {sorted(duck_rows.columns)}"
    if len(spark_rows) != len(duck_rows):
        return f"rows {len(spark_rows)} != {len(duck_rows)}"
    a, b = canonical(spark_rows), canonical(duck_rows)
    if a == b:
        return None
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, first: {bad[0]}"
