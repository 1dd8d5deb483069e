"""Period counts and windows over them.

Windows here run on *aggregated* periods (days, months, quarters), whose
number is bounded by the calendar span, so an unpartitioned window over
them is one small task (section 4.3 rule 1).  Raw-row ordering never goes
through these functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.dates import day_of_week0, days_between, period_start, span_days

_STEPS = {"day": "1 day", "week": "7 days", "month": "1 month", "quarter": "3 months", "year": "1 year"}


def counts_by_period(
    df: DataFrame,
    ts: str,
    period: str = "month",
    *,
    where: Column | None = None,
    spine: bool = False,
    out_period: str = "period",
    out: str = "n",
) -> DataFrame:
    """A34/DT2: rows per calendar period (a DATE: the period's first day).

    With ``spine=True`` periods without rows appear with 0 (S4): each counted
    period is followed by the empty ones up to the next, from the counts alone,
    so the rows are read once.  A NULL period keeps its own row.
    """
    src = df.where(where) if where is not None else df
    counts = src.groupBy(period_start(ts, period).alias(out_period)).agg(F.count(F.lit(1)).cast("bigint").alias(out))
    if not spine:
        return counts
    step = F.expr(f"INTERVAL {_STEPS[period]}")
    at = F.col(out_period)
    # a window over the counted periods, bounded by the calendar span
    until = F.lead(at).over(Window.orderBy(at.asc_nulls_last()))
    gap = counts.withColumn("_cl_last", F.coalesce((until - step).cast("date"), at))
    days = F.when(at.isNull(), F.array(at)).otherwise(F.sequence(at, "_cl_last", step))
    spread = gap.withColumn("_cl_at", F.explode(days))
    return spread.select(F.col("_cl_at").alias(out_period), F.when(F.col("_cl_at").eqNullSafe(at), F.col(out)).otherwise(0).alias(out))


def calendar_spine(df: DataFrame, date_col: str, period: str = "day", *, out: str = "day") -> DataFrame:
    """Every period between the min and max of ``date_col``
    (``generate_series``).  One row per period of the span."""
    bounds = df.agg(F.min(F.col(date_col).cast("date")).alias("_lo"), F.max(F.col(date_col).cast("date")).alias("_hi"))
    return bounds.select(F.explode(F.sequence("_lo", "_hi", F.expr(f"INTERVAL {_STEPS[period]}"))).alias(out))


def neighbours(df: DataFrame, order: str, value: str, *, prev: str = "prev", next_: str = "next") -> DataFrame:
    """Previous and next value along ``order``; ``df`` holds one row
    per period (e.g. from :func:`counts_by_period`)."""
    w = Window.orderBy(F.col(order).asc())
    return df.withColumns({prev: F.lag(value).over(w), next_: F.lead(value).over(w)})


def moving_average(df: DataFrame, order: str, value: str, preceding: int, *, out: str = "moving_avg",
                   scale: int | None = 4) -> DataFrame:
    """Mean over ``ROWS BETWEEN preceding PRECEDING AND CURRENT ROW``;
    ``df`` holds one row per period."""
    w = Window.orderBy(F.col(order).asc()).rowsBetween(-preceding, 0)
    v = F.avg(value).over(w)
    return df.withColumn(out, F.round(v, scale) if scale is not None else v)


def cumulative(df: DataFrame, order: str, value: str, *, out: str = "running") -> DataFrame:
    """Running sum ``ROWS UNBOUNDED PRECEDING``; ``df`` holds one
    row per period (for running sums over raw rows use
    :func:`cohortlens.operators.ranking.ordered_index`)."""
    w = Window.orderBy(F.col(order).asc()).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(value).over(w))


def day_gap(df: DataFrame, ts: str, start: str, end: str, *, day: str = "day", out: str = "n") -> DataFrame:
    """Q16: rows per day in the half-open range ``[start, end)`` (F7 keeps the
    raw column in the filter so it is pushed to the scan), the previous
    active day, the gap in days, the number of active days and the total."""
    src = df.where((F.col(ts) >= F.lit(start).cast("timestamp_ntz")) & (F.col(ts) < F.lit(end).cast("timestamp_ntz")))
    daily = src.groupBy(F.col(ts).cast("date").alias(day)).agg(F.count(F.lit(1)).cast("bigint").alias(out))
    w = Window.orderBy(F.col(day).asc())
    whole = Window.partitionBy()
    return daily.withColumns({
        "prev_day": F.lag(day).over(w),
        "active_days": F.count(F.lit(1)).over(whole).cast("bigint"),
        "range_total": F.sum(out).over(whole).cast("bigint"),
    }).withColumn("gap_days", days_between(day, "prev_day"))


def date_span(df: DataFrame, ts: str) -> DataFrame:
    """First, last and ``EXTRACT(DAY FROM last - first)``."""
    agg = df.agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
    return agg.withColumn("span_days", span_days("last_ts", "first_ts"))


def weekday_counts(df: DataFrame, ts: str, *, days: list[int] | None = None, out: str = "n") -> DataFrame:
    """A34/DT1/D8: rows per day of week with Sunday = 0, optionally only the
    listed days (F9)."""
    dow = day_of_week0(ts).alias("dow")
    src = df.select(dow)
    if days is not None:
        src = src.where(F.col("dow").isin(days))
    return src.groupBy("dow").agg(F.count(F.lit(1)).cast("bigint").alias(out))
