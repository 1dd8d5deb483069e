"""Oracle comparison used by the tests: run a Spark query and a DuckDB
statement on the same Parquet tables and compare row count, column names
and an order-insensitive hash of the values."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os

from pyspark.sql import DataFrame

from cohortlens.sources.tables import DRIVER_TABLES


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in DRIVER_TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(float(v))
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def _digest(cols: list[str], rows: list[tuple]) -> tuple[str, list[str]]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(df: DataFrame, con, sql: str) -> dict:
    s_rows = [tuple(r) for r in df.collect()]
    s_cols = df.columns
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    res = {
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "cols_match": sorted(s_cols) == sorted(d_cols),
        "spark_cols": s_cols,
        "oracle_cols": d_cols,
    }
    hs, ls = _digest(s_cols, s_rows)
    hd, ld = _digest(d_cols, d_rows)
    res["hash_match"] = hs == hd
    if hs != hd:
        only_s = sorted(set(ls) - set(ld))[:3]
        only_d = sorted(set(ld) - set(ls))[:3]
        res["diff"] = {"spark_only": only_s, "oracle_only": only_d}
    res["ok"] = res["cols_match"] and res["hash_match"] and len(s_rows) == len(d_rows)
    return res
