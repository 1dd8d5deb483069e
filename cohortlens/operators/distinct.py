"""Distinct counts that roll up: exact, mergeable sets of whole numbers.

A set is kept as bitmaps of 32,768 numbers each, one row per (group, bitmap).
Sets of finer groups are merged into those of coarser ones by OR, so counts
per year need the stored sets of the months, not the rows.  Both steps are
partial and final aggregates: a hot group is spread over the bitmaps that its
numbers fall into.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITMAP = "bits"


def distinct_sets(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """``(group..., bucket, bits)``: the distinct non-NULL ``value`` (whole
    numbers) of each group."""
    rows = df.where(F.col(value).isNotNull()).withColumn("_cl_v", F.col(value).cast("bigint"))
    rows = rows.withColumn("bucket", F.bitmap_bucket_number("_cl_v"))
    return rows.groupBy(*group, "bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position("_cl_v")).alias(BITMAP))


def merged_sets(sets: DataFrame, group: Sequence[str]) -> DataFrame:
    """The sets of coarser groups, whose columns ``sets`` has."""
    return sets.groupBy(*group, "bucket").agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))


def set_sizes(sets: DataFrame, group: Sequence[str], out: str = "n_distinct") -> DataFrame:
    """``(group..., n)``: the number of distinct values of each group."""
    return sets.groupBy(*group).agg(F.sum(F.bitmap_count(BITMAP)).cast("bigint").alias(out))
