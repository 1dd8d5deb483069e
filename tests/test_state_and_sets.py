"""Mergeable sets, closures, change sets, keyed stream state and salted joins
against plain computations."""

import os

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import distinct, joins, links, ranking
from cohortlens.sources import changes, write_snapshot
from cohortlens.streaming import guards


def test_sets_of_negative_zero_and_far_numbers_merge_exactly(spark):
    numbers = [0, -1, 1, 32767, 32768, 32769, -32768, 2**40, -(2**40), None, 1, 1]
    df = spark.createDataFrame([(f"g{i % 3}", i % 2, n) for n in numbers for i in range(6)], "a string, b int, v long")
    sets = distinct.distinct_sets(df, ["a", "b"], "v")
    fine = {(r["a"], r["b"]): r["n_distinct"] for r in distinct.set_sizes(sets, ["a", "b"]).collect()}
    assert fine == {(f"g{i % 3}", i % 2): len({n for n in numbers if n is not None}) for i in range(6)}
    half = df.where((F.col("b") == 0) | (F.col("v") > 0))
    merged = distinct.merged_sets(distinct.distinct_sets(half, ["a", "b"], "v"), ["a"])
    assert {r["n_distinct"] for r in distinct.set_sizes(merged, ["a"]).collect()} == {9}


def test_closure_follows_a_long_chain_and_stops(spark):
    chain = [(f"e{i}", f"i{i}") for i in range(12)] + [(f"e{i + 1}", f"i{i}") for i in range(12)]
    rows = chain + [("lone", "x"), (None, "i3"), ("e4", None), ("e2", "i2"), ("loop", "i0")]
    df = spark.createDataFrame(rows, "e string, i string")
    got = {r["e"]: r["hop"] for r in links.linked_closure(df, "e", "i", spark.createDataFrame([("e0",)], "e string")).collect()}
    assert got == {**{f"e{i}": i for i in range(13)}, "loop": 1}
    assert links.linked_closure(df, "e", "i", spark.createDataFrame([], "e string")).count() == 0


def test_patch_leaves_files_of_other_partitions(spark, scratch):
    path = os.path.join(scratch, "snap")
    snap = write_snapshot(spark.range(60).select("id", (F.col("id") * 10).alias("v"), (F.col("id") % 3).cast("string").alias("part")), path, partition_by=["part"])
    files = lambda: {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.startswith("part-")}
    before = files()
    wanted = spark.createDataFrame([(1, "1", 7, 2), (1, "1", 9, 1), (4, "1", 5, 1), (99, "1", 5, 1)], "id long, part string, w long, rank int")
    best = changes.one_match(wanted, ["id"], [F.col("rank")])
    got = {r["id"]: (r["v"], r["part"]) for r in changes.patch_snapshot(snap, path, best, "id", "part", {"v": "w"}).collect()}
    assert got == {**{i: (i * 10, str(i % 3)) for i in range(60)}, 1: (9, "1"), 4: (5, "1")}
    after = files()
    assert {f: t for f, t in before.items() if "part=1" not in f} == {f: t for f, t in after.items() if "part=1" not in f}
    assert not {f for f in before if "part=1" in f} & set(after)


def test_alert_once_over_batches_and_a_restart(spark, scratch):
    source, sink = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    events = spark.createDataFrame([(i, i % 4, float(50 + i * 10)) for i in range(12)], "event_id long, user_id long, value double")
    run = lambda: guards.alert_once_stream(spark, source, events.schema, F.col("value") > 100, "user_id", F.concat(F.lit("user "), F.col("user_id")), sink, event_key="event_id")
    events.where("event_id < 8").repartition(3).write.parquet(source)
    run()
    events.repartition(2).write.mode("append").parquet(source)  # delivered again, with four new events
    run()
    got = sorted(r["user_id"] for r in spark.read.parquet(sink).collect())
    assert got == sorted({r["user_id"] for r in events.where("value > 100").collect()})


def test_stratified_sample_keeps_k_rows_of_hot_and_small_strata(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") < 30, None).otherwise((F.col("id") % 50).cast("string")).alias("s"))
    got = ranking.stratified_sample(df, "s", "id", 7, seed=5)
    w = got.groupBy("s").count().collect()
    assert len(w) == 52 and all(r["count"] == 7 for r in w)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, ranking.stratified_sample(df.repartition(7), "s", "id", 7, seed=5).collect()), key=str)
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot", [0, 400])
def test_outer_join_with_a_salted_key_equals_the_plain_one(spark, hot):
    left = spark.createDataFrame([(i, f"p{i}") for i in (1, 1, 2, 3, None)], "k int, p string")
    right = spark.createDataFrame([(1, i % 5) for i in range(hot)] + [(2, 1), (4, 2), (None, 3)], "k int, v int")
    got = sorted(map(str, joins.outer_join(left, right, "k").collect()))
    assert got == sorted(map(str, left.join(right, "k", "left").collect()))
