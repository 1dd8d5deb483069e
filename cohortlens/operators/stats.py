"""Correlation and spread."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators._util import as_list


def _grouped(df: DataFrame, by):
    by = as_list(by) if by else []
    return df.groupBy(*by)


def correlate(df: DataFrame, x: str, y: str, *, by: str | Sequence[str] | None = None, scale: int | None = 4,
              out: str = "corr") -> DataFrame:
    """Pearson correlation (NULL for fewer than two pairs)."""
    v = F.corr(x, y)
    return _grouped(df, by).agg((F.round(v, scale) if scale is not None else v).alias(out))


def spread(df: DataFrame, col: str, *, by: str | Sequence[str] | None = None, scale: int | None = 4) -> DataFrame:
    """Mean, sample std and variance, population variance, all in
    one pass (the reference's cross join to a one-row mean is ``var_pop``)."""
    c = F.col(col)
    exprs = {
        "mean": F.avg(c), "std_samp": F.stddev_samp(c), "var_samp": F.var_samp(c), "var_pop": F.var_pop(c),
    }
    return _grouped(df, by).agg(
        *[(F.round(e, scale) if scale is not None else e).alias(k) for k, e in exprs.items()]
    )


def min_max_avg(df: DataFrame, col: str, *, by: str | Sequence[str] | None = None, scale: int | None = 4) -> DataFrame:
    """Minimum, maximum and mean."""
    c = F.col(col)
    r = (lambda e: F.round(e, scale)) if scale is not None else (lambda e: e)
    return _grouped(df, by).agg(r(F.min(c)).alias("min_value"), r(F.max(c)).alias("max_value"), r(F.avg(c)).alias("avg_value"))
