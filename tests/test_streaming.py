"""G1 on a stream: the same alert rule on readStream gives the batch
result, and a restart with the same checkpoint re-emits nothing."""

import os

import pytest

from pyspark.sql import functions as F

from cohortlens.sources.schemas import DRIVER_SCHEMAS
from cohortlens.streaming import guards

from conftest import SF_TINY


def _msg():
    return F.concat(F.lit("WARNING: value "), F.col("value").cast("string"), F.lit(" for user "),
                    F.col("user_id").cast("string"))


def test_alert_stream_matches_batch(spark, scratch):
    sink = os.path.join(scratch, "alerts")
    ckpt = os.path.join(scratch, "ckpt")
    pred = F.col("value") > 100
    q = guards.alert_stream(spark, SF_TINY, DRIVER_SCHEMAS["events"], pred, _msg(), sink,
                            keep=["event_id"], glob="events.parquet", checkpoint_dir=ckpt)
    assert q.exception() is None
    streamed = spark.read.parquet(sink)
    batch = guards.alerts(spark.read.parquet(f"{SF_TINY}/events.parquet"), pred, _msg(), keep=["event_id"])
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0
    # restart: the checkpoint records the file as processed
    guards.alert_stream(spark, SF_TINY, DRIVER_SCHEMAS["events"], pred, _msg(), sink,
                        keep=["event_id"], glob="events.parquet", checkpoint_dir=ckpt)
    assert spark.read.parquet(sink).count() == batch.count()


def test_constrained_ingest_on_stream(spark, scratch):
    stream = (spark.readStream.schema(DRIVER_SCHEMAS["events"]).option("pathGlobFilter", "events.parquet")
              .parquet(SF_TINY))
    acc, rej = guards.constrained_ingest(stream, {"value_gt_8": F.col("value") > 8})
    outs = {}
    for name, df in (("acc", acc), ("rej", rej)):
        path = os.path.join(scratch, name)
        q = (df.writeStream.format("parquet").option("path", path)
             .option("checkpointLocation", os.path.join(scratch, f"ck_{name}")).trigger(availableNow=True).start())
        q.awaitTermination()
        outs[name] = spark.read.parquet(path).count()
    total = spark.read.parquet(f"{SF_TINY}/events.parquet").count()
    assert outs["acc"] + outs["rej"] == total and outs["rej"] > 0


def test_ingest_stream_two_sinks_exactly_once(spark, scratch):
    acc_dir, rej_dir = os.path.join(scratch, "acc"), os.path.join(scratch, "rej")
    ckpt = os.path.join(scratch, "ck")
    rules = {"value_gt_8": F.col("value") > 8}
    for _ in range(2):  # the second run finds nothing new
        guards.ingest_stream(spark, SF_TINY, DRIVER_SCHEMAS["events"], rules, acc_dir, rej_dir,
                             glob="events.parquet", checkpoint_dir=ckpt)
    acc, rej = spark.read.parquet(acc_dir), spark.read.parquet(rej_dir)
    src = spark.read.parquet(f"{SF_TINY}/events.parquet")
    assert acc.count() + rej.count() == src.count()
    assert rej.where(F.col("reason") != "value_gt_8").count() == 0
    assert acc.drop("batch_id").exceptAll(src.where(F.col("value") > 8)).count() == 0


def test_publish_snapshot_change_path(spark, scratch):
    import pytest

    events = spark.read.parquet(f"{SF_TINY}/events.parquet")
    rules = {"value_gt_8": F.col("value") > 8}
    rep = guards.publish_snapshot(None, events, os.path.join(scratch, "v1"), "event_id", rules=rules)
    assert rep["accepted"] + rep["rejected"] == events.count() and rep["deleted"] == 0
    published = spark.read.parquet(rep["path"])
    assert published.count() == rep["accepted"] and published.where(F.col("value") <= 8).count() == 0
    # a new version that drops rows is refused and writes nothing
    with pytest.raises(ValueError):
        guards.publish_snapshot(events, events.where(F.col("event_id") % 10 != 0), os.path.join(scratch, "v2"), "event_id")
    assert not os.path.exists(os.path.join(scratch, "v2"))


def test_default_stream_checkpoints_are_per_pipeline(spark, scratch):
    a, b = os.path.join(scratch, "a"), os.path.join(scratch, "b")
    for sink in (a, b):  # no explicit checkpoint: each sink gets its own progress
        guards.alert_stream(spark, SF_TINY, DRIVER_SCHEMAS["events"], F.col("value") > 100, _msg(), sink,
                            keep=["event_id"], glob="events.parquet")
    assert spark.read.parquet(a).count() == spark.read.parquet(b).count() > 0


def _arrive(spark, folder, name, rows):
    spark.createDataFrame(rows, "k long, v double").coalesce(1).write.parquet(os.path.join(folder, name))


def test_alert_stream_goes_on_where_it_stopped_without_a_configured_folder(spark, scratch):
    source, sink = os.path.join(scratch, "in"), os.path.join(scratch, "alerts")
    schema = spark.createDataFrame([], "k long, v double").schema
    run = lambda s: guards.alert_stream(s, source + "/*", schema, F.col("v") > 1, F.lit("high"), sink, keep=["k"])
    _arrive(spark, source, "a", [(1, 2.0), (2, 3.0), (3, 0.0)])
    run(spark)
    _arrive(spark, source, "b", [(4, 2.0), (5, 9.0)])
    run(spark.newSession())
    assert sorted(r["k"] for r in spark.read.parquet(sink).collect()) == [1, 2, 4, 5]


def test_stream_with_lost_progress_is_refused(spark, scratch):
    source, sink = os.path.join(scratch, "in"), os.path.join(scratch, "alerts")
    schema = spark.createDataFrame([], "k long, v double").schema
    _arrive(spark, source, "a", [(1, 2.0)])
    _arrive(spark, scratch, "alerts", [(7, 7.0)])
    with pytest.raises(ValueError, match="progress"):
        guards.alert_stream(spark, source + "/*", schema, F.col("v") > 1, F.lit("high"), sink)
    with pytest.raises(ValueError, match="progress"):
        guards.ingest_stream(spark, source + "/*", schema, {}, sink, os.path.join(scratch, "rejected"))


def test_publish_guards_the_published_keys(spark, scratch):
    prev = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k long, v double")
    new = spark.createDataFrame([(1, 1.0), (2, -2.0)], "k long, v double")
    rules = {"positive": F.col("v") > 0}
    with pytest.raises(ValueError, match="deleted"):
        guards.publish_snapshot(prev, new, os.path.join(scratch, "a"), "k", rules=rules)
    assert not os.path.exists(os.path.join(scratch, "a"))
    out = guards.publish_snapshot(prev, new, os.path.join(scratch, "b"), "k", rules=rules, forbid_deletes=False)
    assert (out["accepted"], out["rejected"], out["deleted"]) == (1, 1, 1)
    with pytest.raises(FileExistsError):
        guards.publish_snapshot(None, spark.read.parquet(out["path"]), os.path.join(scratch, "b"), "k")
    assert spark.read.parquet(out["path"]).count() == 1


def test_publish_without_accepted_rows_and_reserved_rule_names(spark, scratch):
    new = spark.createDataFrame([(1, -1.0)], "k long, v double")
    for name, df in (("none", new), ("empty", new.limit(0))):
        out = guards.publish_snapshot(None, df, os.path.join(scratch, name), "k", rules={"positive": F.col("v") > 0})
        back = spark.read.parquet(out["path"])
        assert back.count() == out["accepted"] == 0 and back.columns == ["k", "v"]
    with pytest.raises(ValueError, match="accepted"):
        guards.publish_snapshot(None, new, os.path.join(scratch, "r"), "k", rules={"accepted": F.col("v") > 0})
