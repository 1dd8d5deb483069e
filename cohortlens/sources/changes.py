"""Change sets on a partitioned snapshot: only the partitions that a change
touches are read again and rewritten (C2, C5, J12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.operators._util import as_list


def one_match(changes: DataFrame, keys: str | Sequence[str], best: Sequence[Column]) -> DataFrame:
    """One row of ``changes`` per key, the first in the order ``best``: an
    update that several rows match takes the same one in every run.  The order
    must be total within a key."""
    keys = as_list(keys)
    picked = changes.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in changes.columns if c not in keys]), F.struct(*best)).alias("_cl_row"))
    return picked.select(*keys, "_cl_row.*")


def patch_snapshot(snapshot: DataFrame, path: str, changes: DataFrame, keys: str | Sequence[str], partition_by: str, sets: dict[str, str]) -> DataFrame:
    """Apply ``changes (keys, partition column, new values)``, one row per key,
    to the snapshot at ``path``, which is partitioned by ``partition_by``, and
    return a scan of the result.

    ``sets`` names the column of ``changes`` that each changed column takes.
    Rows of a touched partition without a change stay; files of all other
    partitions are neither read nor written.  The new files replace the old
    ones of their partitions when the job commits (dynamic partition
    overwrite), so a failed job leaves the snapshot as it was.
    """
    keys = as_list(keys)
    spark, columns = snapshot.sparkSession, snapshot.columns
    touched = changes.select(partition_by).distinct()
    names = {c: f"_cl_new_{c}" for c in sets}
    new = changes.select(*keys, partition_by, *[F.col(src).alias(names[c]) for c, src in sets.items()], F.lit(True).alias("_cl_hit"))
    rows = snapshot.join(F.broadcast(touched) if _few(touched) else touched, partition_by, "left_semi")
    joined = rows.join(new, [*keys, partition_by], "left")
    value = lambda c: F.when(F.col("_cl_hit"), F.col(names[c])).otherwise(F.col(c)).alias(c) if c in sets else F.col(c)
    patched = joined.select(*[value(c) for c in columns])
    patched.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path)
    return spark.read.schema(snapshot.schema).parquet(path).select(*columns)


#: Touched partitions that are broadcast, so that the scan prunes by them.
FEW_PARTITIONS = 10_000


def _few(touched: DataFrame) -> bool:
    return touched.limit(FEW_PARTITIONS + 1).count() <= FEW_PARTITIONS
