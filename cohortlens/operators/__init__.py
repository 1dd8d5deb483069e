"""Cohort-analytics operators: DataFrame(s) in, lazy DataFrame out."""

from cohortlens.operators import (
    enrich,
    groups,
    joins,
    links,
    nested,
    pivots,
    ranking,
    rates,
    stats,
    textops,
    timeseries,
)

__all__ = ["enrich", "groups", "joins", "links", "nested", "pivots", "ranking", "rates", "stats", "textops", "timeseries"]
