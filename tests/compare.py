"""Runs queries in Spark and their SQL in DuckDB, and compares the rows."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def database(sf_dir: str = DATA) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path if os.path.isfile(path) else path + '/*.parquet'}')")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    out = []
    for r in df[sorted(df.columns)].itertuples(index=False):
        out.append(tuple(None if pd.isna(x) else f"{x:.6g}" if isinstance(x, float) else str(x) for x in r))
    return sorted(out, key=str)
