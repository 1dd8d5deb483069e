"""Working tables in the shared folder that ``spark.checkpoint.dir`` names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cohortlens.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table and read back: the work is done once, its
    lineage ends, and a lost executor loses nothing of it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
