"""Physical layout of written snapshots.

Filters on a column that the data is clustered by skip whole files and
Parquet row groups through their min/max statistics, without any index.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_clustered_snapshot(
    df: DataFrame,
    path: str,
    cluster_by: Sequence[str],
    *,
    partition_by: Sequence[str] = (),
    files: int | None = None,
) -> DataFrame:
    """Write ``df`` range-partitioned and sorted on ``cluster_by`` (inside
    any ``partition_by`` folders) and return a scan of the result.

    Each output file then covers a narrow, non-overlapping key range, so a
    half-open date filter on an admissions table clustered by date reads
    only the files and row groups that can match.  ``files`` defaults to
    the session's shuffle partition count.
    """
    spark = df.sparkSession
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*partition_by, *cluster_by]
    laid = df.repartitionByRange(n, *[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    writer = laid.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def write_bucketed_table(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    buckets: int,
    *,
    sort: bool = True,
    mode: str = "overwrite",
) -> DataFrame:
    """Save ``df`` as a catalog table bucketed (and sorted) by ``keys``.

    Two tables bucketed on their join keys with the same bucket count join
    without any shuffle (and, sorted, without a sort): the layout pays the
    shuffle once at write time instead of in every later join.
    """
    writer = df.write.mode(mode).bucketBy(buckets, *keys)
    if sort:
        writer = writer.sortBy(*keys)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)
