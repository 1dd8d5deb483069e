"""Physical plan checks: no cartesian product or nested-loop
join except against one-row sides, no single-partition window over raw
rows in the ranking keys, filters and column pruning reach the scan."""

import pytest

from cohortlens.plans.catalog import REGISTRY, build
from cohortlens.plans.inspect import check_plan, plan_text, unbounded_single_partition

from conftest import SF_SMALL


@pytest.mark.parametrize("key", sorted(REGISTRY))
def test_no_unbounded_nested_loops(spark, key):
    problems = check_plan(build(spark, key, SF_SMALL))
    assert not problems, problems


def test_filters_and_pruning_reach_scan(spark):
    txt = plan_text(build(spark, "top_group_in_month", SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in txt
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in txt


@pytest.mark.parametrize("key", ["rank_desc", "ntile_quartiles", "cume_dist", "serial_number"])
def test_raw_row_ranking_not_single_partition(spark, key):
    """The only single-partition exchanges allowed are over the per-bucket offsets
    table (a row per bucket) and over partial aggregates (a row per task: the
    number of rows, the sampled keys)."""
    lines = plan_text(build(spark, key, SF_SMALL), "extended").splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = "\n".join(lines[i + 1: i + 4])
            assert "_cl_bucket" in below or "functions=[partial_" in lines[i + 1], f"single-partition exchange over raw rows in {key}: {line.strip()}"


@pytest.mark.parametrize("key", sorted(REGISTRY))
def test_single_partition_only_over_bounded_input(spark, key):
    problems = unbounded_single_partition(build(spark, key, SF_SMALL))
    assert not problems, problems


def test_checker_flags_global_window_over_raw_rows(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from cohortlens.sources import tables

    c = tables(spark, SF_SMALL).customer
    bad = c.withColumn("r", F.rank().over(Window.orderBy("c_acctbal")))
    assert unbounded_single_partition(bad)
    ok = c.groupBy("c_mktsegment").count().withColumn("r", F.rank().over(Window.orderBy("count")))
    assert not unbounded_single_partition(ok)


def test_bucketed_tables_join_without_shuffle(spark):
    from pyspark.sql import functions as F

    from cohortlens.sources import tables, write_bucketed_table

    t = tables(spark, SF_SMALL)
    o = write_bucketed_table(t.orders.select("o_orderkey", "o_custkey"), "orders_by_key", ["o_orderkey"], 8)
    li = write_bucketed_table(t.lineitem.select("l_orderkey", "l_quantity"), "lineitem_by_key", ["l_orderkey"], 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(F.sum("l_quantity"))
        txt = plan_text(j, "extended")
        join_part = txt[txt.index("SortMergeJoin"):]
        assert "Exchange" not in join_part.split("HashAggregate")[0]  # no shuffle below the join
        assert j.count() == t.orders.select("o_custkey").distinct().count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def scans_and_exchanges(spark, df):
    """Counted on the plan as a large input has it, without broadcasts."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        txt = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    return txt.count("FileScan"), txt.count("Exchange hashpartitioning")


def test_inputs_are_scanned_no_more_than_needed(spark):
    from cohortlens.sources import tables

    t = tables(spark, SF_SMALL)
    assert scans_and_exchanges(spark, REGISTRY["delete_guard"].build(t)) == (2, 1)
    assert scans_and_exchanges(spark, REGISTRY["spine_fill"].build(t))[0] == 1
    scans, exchanges = scans_and_exchanges(spark, REGISTRY["linked_rows"].build(t))
    assert scans == 5  # lines and orders for the seeds and for the result, and parts
    assert exchanges <= 8


def test_lookup_and_quantiles_read_each_table_once_or_twice(spark):
    from cohortlens.sources import tables

    t = tables(spark, SF_SMALL)
    lookup = REGISTRY["range_lookup"].build(t)
    assert scans_and_exchanges(spark, lookup)[0] <= 3  # customer for the values, for the bounds, and for their chunks
    assert "SortMergeJoin" not in plan_text(lookup, "extended")
    quantiles = plan_text(REGISTRY["profile_quantiles"].build(t), "extended")
    for line in quantiles.splitlines():  # the only order is that of counted values
        assert "Sort [o_totalprice" not in line
    light = REGISTRY["records_per_entity"].build(t)._jdf.queryExecution().executedPlan().toString()
    first = light[: light.index("_cl_times")]
    window, gather = first.index("Window"), first.index("ObjectHashAggregate")
    assert "Exchange" not in first[gather:window]  # records are numbered and gathered in one place


def test_no_checkpoint_in_ordered_operators():
    import inspect

    from cohortlens.operators import links, nested, ranking

    assert not any("checkpoint(" in inspect.getsource(m) for m in (links, nested, ranking))
