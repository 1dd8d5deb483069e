"""Scans, inline rows and snapshot writes."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cohortlens.sources.schemas import DRIVER_SCHEMAS

DRIVER_TABLES = tuple(DRIVER_SCHEMAS)


def read_table(spark: SparkSession, base_dir: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan ``{base_dir}/{name}.parquet`` (a file or a folder of files).

    The declared schema skips inference; Catalyst prunes unused columns and
    pushes filters into the Parquet reader.
    """
    schema = schema or DRIVER_SCHEMAS.get(name)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(os.path.join(base_dir, f"{name}.parquet"))


class tables:  # noqa: N801 - used as a namespace: ``t = tables(spark, dir); t.orders``
    """Lazy accessor for the driver tables under one folder."""

    def __init__(self, spark: SparkSession, base_dir: str):
        self.spark = spark
        self.base_dir = base_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in DRIVER_SCHEMAS:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.base_dir, name)
        return self._cache[name]


def inline_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """S3: ``INSERT … VALUES`` as a small DataFrame with a declared schema."""
    return spark.createDataFrame(rows, schema)


def write_snapshot(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a new immutable snapshot and return a scan of it; a path that
    exists is refused.

    Changes never rewrite the input in place: the caller publishes the new
    path.  Partitioning by a date part makes later half-open date filters
    prune whole folders.
    """
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    # read back with the written schema: partition columns keep their types
    # and position instead of being inferred from folder names
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def register_views(spark: SparkSession, base_dir: str, names: tuple[str, ...] = DRIVER_TABLES) -> list[str]:
    """Register each table under ``base_dir`` as a temporary view of the same
    name, for users who work in ``spark.sql``.  Returns the registered names."""
    from pyspark.errors import AnalysisException

    done = []
    for n in names:
        try:  # existence is checked by Spark itself, so remote file systems work
            read_table(spark, base_dir, n).createOrReplaceTempView(n)
        except AnalysisException:
            continue
        done.append(n)
    return done
