"""Date expressions (DT1-DT7, D8-D11)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _c(x: ColumnLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def month_start(col: ColumnLike) -> Column:
    """DT2/D11: first day of the month as a DATE (zone-free)."""
    return F.trunc(_c(col).cast("date"), "month")


def period_start(col: ColumnLike, period: str) -> Column:
    """First day of ``day|week|month|quarter|year`` as a DATE."""
    d = _c(col).cast("date")
    if period == "day":
        return d
    if period == "week":
        return F.date_trunc("week", d).cast("date")
    return F.trunc(d, period)


def day_of_week0(col: ColumnLike) -> Column:
    """Day of week with Sunday = 0 (PostgreSQL ``EXTRACT(DOW)``)."""
    return (F.dayofweek(_c(col)) - 1).cast("bigint")


def days_between(end: ColumnLike, start: ColumnLike) -> Column:
    """DT6/D9: whole calendar days ``end::date - start::date``."""
    return F.datediff(_c(end).cast("date"), _c(start).cast("date")).cast("bigint")


def span_days(later: ColumnLike, earlier: ColumnLike) -> Column:
    """``EXTRACT(DAY FROM later - earlier)``, whole days floored."""
    diff = _c(later).cast("timestamp_ntz") - _c(earlier).cast("timestamp_ntz")
    return F.extract(F.lit("DAY"), diff).cast("bigint")


def age_as_of(birth_year: ColumnLike, as_of: str) -> Column:
    """X1/DT7: ``year(as_of) - birth_year``; the as-of date is a parameter so
    results stay reproducible (never ``current_date`` in a tested result)."""
    return (F.year(F.lit(as_of).cast("date")) - _c(birth_year)).cast("bigint")
