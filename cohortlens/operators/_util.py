from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def as_list(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def check_columns(df: DataFrame, cols: Sequence[str]) -> None:
    """Reject unknown column names up front (the reference quoted names with
    ``format('%I')``; here they are checked against the schema)."""
    known = {c.lower() for c in df.columns}
    missing = [c for c in cols if c.lower() not in known]
    if missing:
        raise ValueError(f"unknown column(s) {missing}; available: {df.columns}")


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (group keys may be NULL);
    the keys are kept once, from the left side."""
    if not keys:
        return left.crossJoin(right)
    r = right
    for k in keys:
        r = r.withColumnRenamed(k, f"_cl_r_{k}")
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_cl_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"_cl_r_{k}" for k in keys])
