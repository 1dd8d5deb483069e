"""Crosstabs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.operators._util import as_list, check_columns


def _named(name: str):
    """A column by its exact name (dots and backticks are not syntax)."""
    return F.col("`" + name.replace("`", "``") + "`")


def pivot_counts(
    df: DataFrame,
    row: str | Sequence[str],
    col: str,
    values: Sequence,
    *,
    fill: int | None = 0,
    prefix: str = "n_",
) -> DataFrame:
    """Rows x declared categories, counts aligned by *value* (a
    missing category is a zero column, never a shift).

    One conditional aggregate per declared value: a single partial + final
    aggregation (Spark's ``pivot()`` plans two), no distinct-values job, and
    a fixed output schema.  ``fill=None`` gives NULL instead of 0 for a
    category absent from a row group.
    """
    row = as_list(row)
    check_columns(df, [*row, col])
    aggs = []
    for v in values:
        c = F.count_if(F.col(col) == F.lit(v)).cast("bigint")
        if fill is None:
            c = F.nullif(c, F.lit(0))
        elif fill != 0:
            c = F.when(c == 0, F.lit(fill).cast("bigint")).otherwise(c)
        aggs.append(c.alias(f"{prefix}{v}"))
    return df.groupBy(*row).agg(*aggs)


def flag_counts(
    df: DataFrame,
    by: str | Sequence[str],
    flags: Mapping[str, Column],
    *,
    flag_col: str = "flag",
    out: str = "n",
    keep_zero: bool = False,
) -> DataFrame:
    """Long table (flag, by..., n) of rows where each named flag
    holds.  The reference ran one filtered scan per flag and a UNION; here
    one aggregate counts every flag per group (map-side partial counts) and
    only the aggregated rows are unpivoted."""
    by = as_list(by)
    clash = set(flags) & set(by)
    if clash:
        raise ValueError(f"flag names {sorted(clash)} collide with group columns")
    wide = df.groupBy(*by).agg(*[F.count_if(c).cast("bigint").alias(k) for k, c in flags.items()])
    # one output row per flag, the flag name as its tag (F15); names are passed
    # as columns, never spliced into SQL text
    long = wide.unpivot([_named(b) for b in by], [_named(k) for k in flags], flag_col, out)
    return long if keep_zero else long.where(F.col(out) > 0)
