"""Results of the partition-sensitive keys (range partitioning, checkpoints,
hash-split parts, windows) do not depend on the number of shuffle
partitions: each still matches the oracle with 3 and 37 partitions."""

import pytest

from cohortlens.plans.catalog import REGISTRY, build
from compare import compare

from conftest import SF_SMALL

SENSITIVE = ["rank_desc", "ntile_quartiles", "cume_dist", "serial_number", "profile_quantiles", "records_per_entity",
             "entity_digest", "array_text", "range_lookup", "top_per_group", "linked_rows", "right_join_view",
             "topk_then_nth", "nth_value_5", "stable_sample", "flag_counts_pivot", "moving_avg_monthly"]


@pytest.mark.parametrize("parts", [3, 37])
@pytest.mark.parametrize("key", SENSITIVE)
def test_key_independent_of_partitioning(spark, duck, key, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        res = compare(build(spark, key, SF_SMALL), duck, REGISTRY[key].sql)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert res["ok"], res


@pytest.mark.parametrize("key", SENSITIVE)
def test_key_without_adaptive_execution(spark, duck, key):
    """Some clusters run with AQE off: the range partitioning, checkpoints
    and part splitting must not depend on it."""
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        res = compare(build(spark, key, SF_SMALL), duck, REGISTRY[key].sql)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert res["ok"], res
