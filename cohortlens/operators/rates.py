"""Shares and rates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.operators._util import as_list, check_columns


def _pct(num: Column, den: Column, scale: int | None, truncate: bool) -> Column:
    if truncate:
        # The reference's integer percentage, (100 * a) div b
        # NULL for a zero total; the total appears once (one scalar subquery)
        return F.call_function("div", num.cast("bigint") * 100, F.nullif(den.cast("bigint"), F.lit(0))).cast("bigint")
    val = F.try_divide(num.cast("double") * 100.0, den.cast("double"))
    return F.round(val, scale) if scale is not None else val


def share_of_total(
    df: DataFrame,
    by: str | Sequence[str],
    *,
    denominator: str = "all",
    truncate: bool = False,
    scale: int | None = 2,
    count_col: str = "n",
    pct_col: str = "pct",
) -> DataFrame:
    """Rows per group and their percentage of all rows.

    ``denominator='all'`` counts NULL groups in the total and keeps their
    row; ``'non_null'`` drops NULL groups from both.  The total is a scalar
    subquery over the *grouped* frame (one row per group), so the input is
    scanned once and no single task sees all groups.
    """
    by = as_list(by)
    check_columns(df, by)  # T13: names are checked, never spliced into SQL
    g = df.groupBy(*by).agg(F.count(F.lit(1)).alias(count_col))
    if denominator == "non_null":
        for c in by:
            g = g.where(F.col(c).isNotNull())
    elif denominator != "all":
        raise ValueError("denominator must be 'all' or 'non_null'")
    total = g.agg(F.sum(count_col)).scalar()
    return g.withColumn(count_col, F.col(count_col).cast("bigint")).withColumn(
        pct_col, _pct(F.col(count_col), total, scale, truncate)
    )


def share_where(df: DataFrame, predicate: Column, *, scale: int | None = 2,
                count_col: str = "n", match_col: str = "n_match", pct_col: str = "pct") -> DataFrame:
    """One row with all rows, matching rows and their percentage,
    in one pass (no scalar subquery re-scanning the table)."""
    agg = df.agg(
        F.count(F.lit(1)).cast("bigint").alias(count_col),
        F.count_if(predicate).cast("bigint").alias(match_col),
    )
    return agg.withColumn(pct_col, _pct(F.col(match_col), F.col(count_col), scale, False))


def conditional_rate(
    df: DataFrame,
    by: str | Sequence[str],
    flag: Column,
    *,
    within: Column | None = None,
    scale: int | None = 4,
    count_col: str = "n",
    flag_col: str = "n_flag",
    rate_col: str = "rate",
    truncate: bool = False,
) -> DataFrame:
    """Per group, rows, rows where ``flag`` holds, and the rate in
    percent.  One partial + final aggregate (the reference's self-join to its
    own aggregate, J10, becomes this single pass).  ``within`` restricts the
    population first (e.g. only patients in a coma)."""
    by = as_list(by)
    check_columns(df, by)
    if within is not None:
        df = df.where(within)
    g = df.groupBy(*by).agg(
        F.count(F.lit(1)).cast("bigint").alias(count_col),
        F.count_if(flag).cast("bigint").alias(flag_col),
    )
    return g.withColumn(rate_col, _pct(F.col(flag_col), F.col(count_col), scale, truncate))


def multi_rate(df: DataFrame, flags: Mapping[str, Column], *, scale: int | None = 4,
               count_col: str = "n") -> DataFrame:
    """One row: rows, and for every named flag its count ``n_<name>`` and
    percentage ``pct_<name>``; a single aggregate replaces one query per flag."""
    aggs = [F.count(F.lit(1)).cast("bigint").alias(count_col)]
    aggs += [F.count_if(c).cast("bigint").alias(f"n_{k}") for k, c in flags.items()]
    res = df.agg(*aggs)
    return res.withColumns({f"pct_{k}": _pct(F.col(f"n_{k}"), F.col(count_col), scale, False) for k in flags})


def category_ratio(df: DataFrame, col: str, left: str, right: str, *, out: str = "ratio") -> DataFrame:
    """``'<count of left>:<count of right>'`` in one conditional aggregate."""
    check_columns(df, [col])
    agg = df.agg(
        F.count_if(F.col(col) == left).cast("bigint").alias(f"n_{left}"),
        F.count_if(F.col(col) == right).cast("bigint").alias(f"n_{right}"),
    )
    return agg.withColumn(out, F.concat_ws(":", F.col(f"n_{left}").cast("string"), F.col(f"n_{right}").cast("string")))
