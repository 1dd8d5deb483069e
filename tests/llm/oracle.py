"""Side-by-side run of a query and its DuckDB statement on the given tables."""

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM read_parquet('{files}')")
    return con


def same(spark, query, sql: str, sf_dir: str) -> pd.DataFrame:
    """The query's rows, after comparing them with the statement's."""
    got, want = query(spark, sf_dir).toPandas(), connect(sf_dir).execute(sql).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    got, want = (x[cols].sort_values(cols, kind="stable").reset_index(drop=True) for x in (got, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False)
    return got
