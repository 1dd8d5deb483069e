"""Joins that stay balanced when one key holds a large share of the rows.

AQE splits a skewed sort-merge join partition only on a side whose rows
may be duplicated safely: either side of an inner join, but for an outer
join only the *preserved* side.  When the hot key sits in the other side
(``customer LEFT JOIN orders`` with one customer owning a third of the
orders), the outer join cannot be split.  ``outer_join`` finds the keys that
hold more than a partition's fair share of the other side (fewer than
partitions, so they are broadcast) and salts them: their rows are dealt over
salts, and a preserved row of such a key is sent to every salt.  A copy that
meets nothing is dropped, as another one has met a row: a hot key exists in
the other side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators._util import as_list


def outer_join(preserved: DataFrame, other: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """``preserved LEFT JOIN other USING (keys)``, skew-safe on ``other``.

    Output columns: the keys once, then the other columns of ``preserved``,
    then those of ``other`` (NULL where no partner).  Rows with a NULL key
    never match, as in SQL.
    """
    keys = as_list(keys)
    slices = int(preserved.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = other.select(*keys).where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)).groupBy(*keys).count()
    share = counts.agg(F.sum("count") / slices).scalar()
    hot = F.broadcast(counts.where(F.col("count") > share).select(*keys, F.lit(True).alias("_cl_hot")))
    salts = min(slices, MAX_SALTS)
    values = [c for c in other.columns if c not in keys]
    dealt = F.when(F.col("_cl_hot"), F.pmod(F.xxhash64(*other.columns), F.lit(salts))).otherwise(F.lit(0)).cast("int")
    right = other.join(hot, keys, "left").select(*keys, *values, dealt.alias("_cl_salt"), F.lit(True).alias("_cl_met"))
    every = F.when(F.col("_cl_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    left = preserved.join(hot, keys, "left").select(*preserved.columns, "_cl_hot", F.explode(every).alias("_cl_salt"))
    joined = left.join(right, [*keys, "_cl_salt"], "left").where("_cl_met OR _cl_hot IS NULL")
    return joined.select(*keys, *[c for c in preserved.columns if c not in keys], *values)


#: Salts of a hot key at most.
MAX_SALTS = 64
