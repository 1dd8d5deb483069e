"""Row-change rules re-aimed as Spark jobs.

The reference used database triggers and a view ``WITH CHECK OPTION``.
Here each rule is a stateless transform, so the same function runs on a
batch DataFrame or on a ``readStream`` one (micro-batches).
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.operators._util import as_list


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, asked of the file system that Spark uses for it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop))


def _progress_folder(spark: SparkSession, sink: str, given: str | None) -> str:
    """Where a stream keeps its progress: beside its sink, so both last equally
    long.  A sink that holds files whose progress is gone is refused: batch
    numbers would start again and rows be skipped or overwritten."""
    folder = given or sink.rstrip("/") + ".progress"
    if path_exists(spark, sink) and not path_exists(spark, folder):
        raise ValueError(f"stream refused: {sink} exists but its progress folder {folder} does not")
    return folder


def alerts(df: DataFrame, predicate: Column, message: Column, *, keep: Sequence[str] = (),
           out: str = "message") -> DataFrame:
    """G1: rows breaking a threshold, with a warning text (AFTER INSERT
    trigger).  Stateless: valid on streaming DataFrames."""
    return df.where(predicate).select(*keep, message.alias(out))


def alert_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    predicate: Column,
    message: Column,
    sink_dir: str,
    *,
    keep: Sequence[str] = (),
    glob: str | None = None,
    checkpoint_dir: str | None = None,
):
    """G1 on a stream: Parquet files arriving in ``source_dir`` are checked
    per micro-batch and alerts appended as Parquet to ``sink_dir``.

    Progress is kept beside the sink, in ``<sink_dir>.progress`` unless
    ``checkpoint_dir`` names a durable folder, so a restarted query, in this or
    another session, resumes exactly where it stopped; a sink without its
    progress is refused.  Runs with ``availableNow`` (drain what is there, then
    stop); returns the finished query.
    """
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    stream = reader.parquet(source_dir)
    ckpt = _progress_folder(spark, sink_dir, checkpoint_dir)
    q = (
        alerts(stream, predicate, message, keep=keep)
        .writeStream.format("parquet")
        .option("path", sink_dir)
        .option("checkpointLocation", ckpt)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q


def alert_once_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    predicate: Column,
    entity: str,
    message: Column,
    sink_dir: str,
    *,
    event_key: str,
    files_per_batch: int = 1,
    glob: str | None = None,
    checkpoint_dir: str | None = None,
):
    """G1/G3 with keyed state: each entity is warned of once, whatever the number
    of its events, batches and restarts; an event delivered again, in any
    batch, counts once.

    Both memories (event keys seen, entities warned) are Spark state stores
    beside the sink, partitioned by their key.  ``message`` may use ``entity``
    alone, so the warning does not depend on which event of a batch came first.
    Runs with ``availableNow``, ``files_per_batch`` files a batch; returns the
    finished query.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    ckpt = _progress_folder(spark, sink_dir, checkpoint_dir)
    events = reader.parquet(source_dir).dropDuplicates([event_key]).where(predicate)
    warned = events.select(entity).dropDuplicates([entity]).select(entity, message.alias("message"))
    q = warned.writeStream.format("parquet").option("path", sink_dir).option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def ingest_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    rules: Mapping[str, Column],
    accepted_dir: str,
    rejected_dir: str,
    *,
    glob: str | None = None,
    checkpoint_dir: str | None = None,
):
    """G3 on a stream: every micro-batch is split once by the rules and both
    sides are written (Parquet) under ``batch_id=<n>`` folders.

    A batch replayed after a failure overwrites its own folders, so each
    batch lands exactly once even though two sinks are written.  Progress is
    kept in ``<accepted_dir>.progress`` unless ``checkpoint_dir`` names a durable
    folder; sinks without their progress are refused.  Runs with
    ``availableNow`` and returns the finished query.
    """
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    stream = tag_violations(reader.parquet(source_dir), rules, out="reason")
    ckpt = _progress_folder(spark, accepted_dir, checkpoint_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            batch.where(F.col("reason").isNull()).drop("reason").write.mode("overwrite").parquet(
                os.path.join(accepted_dir, f"batch_id={batch_id}"))
            batch.where(F.col("reason").isNotNull()).write.mode("overwrite").parquet(
                os.path.join(rejected_dir, f"batch_id={batch_id}"))
        finally:
            batch.unpersist()

    q = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def delete_guard(prev: DataFrame, nxt: DataFrame, keys: str | Sequence[str], *, strict: bool = False) -> DataFrame:
    """Keys present in the previous snapshot but missing in the next
    (deleted rows).  ``strict=True`` raises when any exists, like the
    reference's BEFORE DELETE trigger."""
    keys = as_list(keys)
    # one aggregate over both: NULL keys are a group like any other, so a row
    # with a NULL key that is still present is not a deletion
    both = prev.select(*keys, F.lit(0).alias("_cl_next")).union(nxt.select(*keys, F.lit(1).alias("_cl_next")))
    missing = both.groupBy(*keys).agg(F.max("_cl_next").alias("_cl_next")).where(F.col("_cl_next") == 0).select(*keys)
    if strict and not missing.isEmpty():
        raise ValueError("delete guard: rows were removed between snapshots")
    return missing


def tag_violations(df: DataFrame, rules: Mapping[str, Column], *, out: str = "reason") -> DataFrame:
    """Add ``out`` = name of the first broken rule (NULL counts as broken),
    NULL when every rule holds."""
    reason = None
    for name, rule in rules.items():
        broken = F.coalesce(~rule, F.lit(True))
        reason = F.when(broken, F.lit(name)) if reason is None else reason.when(broken, F.lit(name))
    return df.withColumn(out, reason if reason is not None else F.lit(None).cast("string"))


def ingest_summary(df: DataFrame, rules: Mapping[str, Column], *, accepted: str = "accepted",
                   out: str = "outcome", count_col: str = "n") -> DataFrame:
    """G3 counts in one pass: rows per outcome (``accepted`` or the broken
    rule's name)."""
    tagged = tag_violations(df, rules, out="_cl_reason")
    return tagged.groupBy(F.coalesce(F.col("_cl_reason"), F.lit(accepted)).alias(out)).agg(
        F.count(F.lit(1)).cast("bigint").alias(count_col)
    )


def constrained_ingest(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split incoming rows into (accepted, rejected + reason).

    A rule that evaluates to NULL counts as broken (the reference's check
    option also refused NULL).  ``reason`` is the first broken rule's name.
    accepted + rejected = input.  Stateless, so it also splits a stream.
    """
    tagged = tag_violations(df, rules, out="_cl_reason")
    accepted = tagged.where(F.col("_cl_reason").isNull()).drop("_cl_reason")
    rejected = tagged.where(F.col("_cl_reason").isNotNull()).withColumnRenamed("_cl_reason", "reason")
    return accepted, rejected


def lookup_or_report(
    df: DataFrame,
    key: str,
    ids: DataFrame,
    cols: Sequence[str],
    *,
    id_col: str | None = None,
    strict: bool = False,
    status: str = "status",
) -> DataFrame:
    """For every requested id, its rows (``status='found'``) or
    one row with ``status='not found'``.  ``strict=True`` raises when any id
    is missing."""
    id_col = id_col or key
    from cohortlens.operators.joins import outer_join

    req = ids.select(F.col(id_col).alias(key)).distinct()
    found = df.select(key, *cols).withColumn("_cl_hit", F.lit(True))
    res = outer_join(req, found, key)
    res = res.withColumn(status, F.when(F.col("_cl_hit"), F.lit("found")).otherwise(F.lit("not found"))).drop("_cl_hit")
    if strict and not res.where(F.col(status) == "not found").isEmpty():
        raise KeyError("lookup: some ids were not found")
    return res


def publish_snapshot(
    prev: DataFrame | None,
    new: DataFrame,
    path: str,
    keys: str | Sequence[str],
    *,
    rules: Mapping[str, Column] | None = None,
    forbid_deletes: bool = True,
) -> dict:
    """The change path: check a new version of a table and publish it as an
    immutable snapshot (the reference changed tables in place behind
    triggers).

    1. G3: rows breaking a rule are split off with the rule's name; no rule
       may be called ``accepted``.
    2. G2: keys of ``prev`` that no accepted row has are deletions; with
       ``forbid_deletes`` any deletion aborts before anything is written.
    3. One pass writes all rows partitioned by ``_outcome``
       (``accepted`` or the broken rule); the published snapshot is the
       ``_outcome=accepted`` folder, which exists even if it has no row.

    ``path`` must not exist yet: a snapshot is never overwritten.  Returns
    ``{"path", "accepted", "rejected", "deleted"}`` (counts from the written
    files).
    """
    spark = new.sparkSession
    if "accepted" in (rules or {}):
        raise ValueError("a rule may not be called 'accepted'")
    if path_exists(spark, path):
        raise FileExistsError(f"publish refused: {path} exists")
    tagged = tag_violations(new, rules or {}, out="_outcome")
    tagged = tagged.withColumn("_outcome", F.coalesce(F.col("_outcome"), F.lit("accepted")))
    deleted = 0
    if prev is not None:
        gone = delete_guard(prev, tagged.where(F.col("_outcome") == "accepted"), keys)
        deleted = gone.count()
        if forbid_deletes and deleted:
            raise ValueError(f"publish refused: {deleted} key(s) deleted since the previous snapshot")
    tagged.write.partitionBy("_outcome").parquet(path)
    published = os.path.join(path, "_outcome=accepted")
    if not path_exists(spark, published):
        new.limit(0).write.parquet(published)
    counts = {r["_outcome"]: r["n"] for r in spark.read.schema(tagged.schema).parquet(path).groupBy("_outcome").agg(F.count(F.lit(1)).alias("n")).collect()}
    accepted = counts.pop("accepted", 0)
    return {"path": published, "accepted": accepted, "rejected": sum(counts.values()), "deleted": deleted}
