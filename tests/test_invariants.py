"""Invariants: shares sum to 100, tile sizes differ by at most
one, the last cumulative value is the total, accepted + rejected = input,
scalable ranking equals the plain window and is unchanged under
repartitioning, also with one key holding a third of the rows."""

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import groups, ranking, rates
from cohortlens.operators import timeseries as ts
from cohortlens.sources import tables
from cohortlens.streaming import guards

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def t(spark):
    return tables(spark, SF_SMALL)


@pytest.fixture(scope="module")
def skewed(spark):
    """30,000 rows; value 7.0 holds a third of them; group 'hot' holds half."""
    df = spark.range(30000).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise((F.col("id") * 37 % 1009).cast("double")).alias("v"),
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 5).cast("string"))).alias("g"),
    )
    return df


def test_shares_sum_to_100(t):
    s = rates.share_of_total(t.orders, "o_orderpriority", scale=None).agg(F.sum("pct")).first()[0]
    assert abs(s - 100.0) < 1e-9


def test_ntile_sizes(t):
    q = ranking.ntile_rows(t.customer, 7, [("c_acctbal", True), ("c_custkey", True)], out="q")
    sizes = [r["count"] for r in q.groupBy("q").count().collect()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1 and sum(sizes) == t.customer.count()


def test_cumulative_last_is_total(t):
    d = ts.counts_by_period(t.orders, "o_orderdate", "day", out_period="day")
    c = ts.cumulative(d, "day", "n", out="running")
    assert c.agg(F.max("running")).first()[0] == t.orders.count()


def test_ingest_partition(t):
    acc, rej = guards.constrained_ingest(t.events, {"positive": F.col("value") > 8, "typed": F.col("event_type").isNotNull()})
    assert acc.count() + rej.count() == t.events.count()


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_rank_scalable_equals_window(skewed, parts):
    df = skewed.repartition(parts)
    a = ranking.rank_rows(df, [("v", False)], out="r", method="scalable").select("k", "r")
    b = ranking.rank_rows(df, [("v", False)], out="r", method="window").select("k", "r")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_partitioned_rank_with_hot_group(skewed):
    a = ranking.rank_rows(skewed, [("v", True)], partition=["g"], out="r").select("k", "r")
    b = ranking.rank_rows(skewed, [("v", True)], partition=["g"], out="r", method="window").select("k", "r")
    assert a.exceptAll(b).count() == 0 and a.count() == skewed.count()


def test_row_number_ntile_cume_dist_equal_window(skewed):
    order = [("v", True), ("k", True)]
    for fn, kw in ((ranking.row_number_rows, {}), (ranking.ntile_rows, {"n": 5})):
        if "n" in kw:
            a = fn(skewed, kw["n"], order, out="x").select("k", "x")
            b = fn(skewed, kw["n"], order, out="x", method="window").select("k", "x")
        else:
            a = fn(skewed, order, out="x").select("k", "x")
            b = fn(skewed, order, out="x", method="window").select("k", "x")
        assert a.exceptAll(b).count() == 0
    a = ranking.cume_dist_rows(skewed, [("v", True)], out="x").select("k", "x")
    b = ranking.cume_dist_rows(skewed, [("v", True)], out="x", method="window").select("k", "x")
    assert a.exceptAll(b).count() == 0


def test_exact_quantiles_hot_group(skewed):
    a = groups.profile(skewed, "g", "v", method="exact").orderBy("g").collect()
    b = groups.profile(skewed, "g", "v", method="builtin").orderBy("g").collect()
    assert a == b


def test_top_k_ties_all_kept(skewed):
    # the hot value 7.0 is not at the top; check the threshold path on the tail
    low = ranking.top_k_with_ties(skewed, "v", 3, ascending=True)
    exp = skewed.where(F.col("v") <= skewed.orderBy("v").limit(3).agg(F.max("v")).first()[0]).count()
    assert low.count() == exp


def test_outer_join_equals_left_join_with_hot_key(spark, skewed):
    from cohortlens.operators.joins import outer_join

    dim = spark.range(0, 40).select((F.col("id") - 5).alias("k2"), (F.col("id") * 10).alias("attr"))
    dim = dim.unionByName(spark.createDataFrame([(None, 1)], "k2 long, attr long"))
    fact = skewed.select(F.when(F.col("k") % 3 == 0, F.lit(1)).otherwise(F.col("k") % 17).cast("long").alias("k2"), "v")
    a = outer_join(dim, fact, "k2")
    b = dim.join(fact, on="k2", how="left")
    assert a.count() == b.count()
    assert a.exceptAll(b.select(*a.columns)).count() == 0


def plain_lookup(values, bounds):
    """First bound at or above each value; the smallest label of equal bounds."""
    order = sorted(bounds)
    return {i: next((label for b, label in order if x is not None and b >= x), None) for i, x in values}


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_range_lookup_equals_a_plain_scan(spark, t, parts):
    from cohortlens.operators import links
    from cohortlens.functions.random import stable_uniform

    bounds = links.cumulative_bounds(t.customer, "c_nationkey", out_label="slice")
    u = t.customer.select("c_custkey", stable_uniform("c_custkey", 7).alias("u"))
    u = u.unionByName(spark.createDataFrame([(-1, 2.0), (-2, None), (-3, 0.0)], "c_custkey long, u double"))
    want = plain_lookup(map(tuple, u.collect()), [(r["upper"], r["slice"]) for r in bounds.collect()])
    for method in ("index", "merge"):
        got = {r["c_custkey"]: r["slice"] for r in links.range_lookup(u, "u", bounds, "upper", "slice", method=method, slices=parts).collect()}
        assert got == want, method


@pytest.mark.parametrize("n", [1, 16, 17, 300_000])
def test_range_lookup_places_every_value_among_many_bounds(spark, n):
    from cohortlens.operators import links

    bounds = spark.range(n).select((F.col("id") * 2).alias("upper"), F.col("id").alias("slice"))
    vals = spark.range(-2, 2 * n + 3).select(F.col("id").alias("v"))
    got = links.range_lookup(vals, "v", bounds, "upper", "slice")
    want = F.when(F.col("v") <= 2 * (n - 1), F.ceil(F.greatest("v", F.lit(0)) / 2).cast("long"))
    assert got.where(~F.col("slice").eqNullSafe(want)).isEmpty() and got.count() == 2 * n + 5


def test_range_lookup_refuses_more_bounds_than_it_may_hold(spark):
    from cohortlens.operators import links

    bounds = spark.range(20).select(F.col("id").alias("upper"), F.col("id").alias("slice"))
    with pytest.raises(Exception, match="more than 10 bounds"):
        links.range_lookup(spark.range(3), "id", bounds, "upper", "slice", max_bounds=10).collect()


ORDER_KINDS = ["int", "bigint", "double", "float", "decimal(20,3)", "date", "timestamp", "timestamp_ntz", "string", "boolean", "binary"]


@pytest.mark.parametrize("asc", [True, False])
@pytest.mark.parametrize("kind", ORDER_KINDS)
def test_order_key_compares_like_the_declared_order(spark, kind, asc):
    """NULLs last, extremes, NaN and prefixes included: sorting by the key is
    sorting by the column."""
    from cohortlens.operators import ranking

    texts = [None, "", "a", "ab", "abc", "b", "\u00e9", "\u6f22", "zz", "a" * 70]
    numbers = [None, 0, 1, -1, 5, -2**31, 2**31 - 1]
    if kind in ("string", "binary"):
        df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast(kind).alias("c"))
    elif kind == "date":
        df = spark.createDataFrame([(n,) for n in (None, 0, 1, -1, 9000)], "n int").select(F.date_from_unix_date("n").alias("c"))
    elif kind.startswith("timestamp"):
        df = spark.createDataFrame([(n,) for n in (None, 0, 1, -1, 10**15, -(10**12))], "n long").select(F.timestamp_micros("n").cast(kind).alias("c"))
    elif kind in ("double", "float"):
        df = spark.createDataFrame([(x,) for x in (None, 0.0, 1.5, -1.5, float("nan"), float("inf"), float("-inf"))], f"c {kind}")
    elif kind == "boolean":
        df = spark.createDataFrame([(x,) for x in (None, True, False)], "c boolean")
    else:
        extra = [-(2**63), 2**63 - 1] if kind == "bigint" else []
        df = spark.createDataFrame([(n,) for n in numbers + extra], "n long").select(F.col("n").cast(kind).alias("c"))
    order = [("c", asc)]
    keyed = df.select("c", ranking.order_key(df, order).alias("k"))
    by_key = [str(r["c"]) for r in keyed.orderBy("k").collect()]
    by_column = [str(r["c"]) for r in keyed.orderBy(*ranking._sort_exprs(order)).collect()]
    assert by_key == by_column


@pytest.mark.parametrize("buckets", [1, 2, 16, 17, 300])
def test_buckets_ascend_with_the_order(spark, buckets):
    from cohortlens.operators import ranking

    df = spark.range(5000).select((F.col("id") * 7919 % 1000).alias("v"), F.md5(F.col("id").cast("string")).alias("s"))
    out = ranking.order_bucket(df, [("v", False), ("s", True)], buckets).select("v", "s", "_cl_bucket").toPandas()
    out = out.sort_values(["v", "s"], ascending=[False, True])
    assert out["_cl_bucket"].is_monotonic_increasing and out["_cl_bucket"].nunique() == buckets
    assert out["_cl_bucket"].value_counts().max() <= 4 * 5000 / buckets


@pytest.mark.parametrize("n", [3, 300])
@pytest.mark.parametrize("kinds", [("int", "bigint"), ("bigint", "int"), ("decimal(38,0)", "bigint"), ("date", "timestamp"), ("int", "double")])
def test_range_lookup_compares_in_the_common_type(spark, n, kinds):
    from cohortlens.operators import links

    value, bound = kinds
    ids = spark.range(400).withColumn("k", (F.col("id") * 7 % 1000).cast("int"))
    far = spark.range(n).withColumn("k", (F.col("id") * 3 + 1).cast("int"))
    as_ = lambda c, kind: F.expr(f"cast(date_add(date'2000-01-01', {c}) as {kind})") if kind in ("date", "timestamp") else F.col(c).cast(kind)
    vals = ids.select("id", "k", as_("k", value).alias("x"))
    limits = far.select(as_("k", bound).alias("upper"), F.concat(F.lit("b"), F.col("k")).alias("slice"), "k")
    if bound == "bigint" and value != "bigint":
        limits = limits.unionByName(spark.range(1).select(F.lit(2**40).cast("bigint").alias("upper"), F.lit("far").alias("slice"), F.lit(2**40).alias("k")))
    got = {r["id"]: r["slice"] for r in links.range_lookup(vals, "x", limits.drop("k"), "upper", "slice").collect()}
    assert got == plain_lookup([(r["id"], r["k"]) for r in vals.collect()], [(r["k"], r["slice"]) for r in limits.collect()])


def test_nested_parts_split_hot_entity(skewed):
    from cohortlens.operators import nested

    # group "hot" owns 15,000 rows, the others 3,000 each; parts of 4,000 records
    res = nested.collect_sorted(skewed, "g", ["k", "v"], ["k"], per_part=4000)
    rows = res.select("g", "part", "n", F.size("records").alias("sz")).collect()
    hot = [r for r in rows if r["g"] == "hot"]
    assert len(hot) == 4 and all(r["n"] == r["sz"] for r in rows)
    assert sum(r["n"] for r in rows) == skewed.count()
    assert all(r["part"] == 0 for r in rows if r["g"] != "hot")
    # every record kept exactly once, and each part sorted
    flat = res.select("g", F.explode("records").alias("r")).select("g", "r.k", "r.v")
    assert flat.exceptAll(skewed.select("g", "k", "v")).count() == 0
    first = res.where(F.col("g") == "hot").select(F.col("records")[0]["k"].alias("k0"), F.array_min(
        F.transform("records", lambda x: x["k"])).alias("kmin")).collect()
    assert all(r["k0"] == r["kmin"] for r in first)


@pytest.mark.parametrize("slices", [1, 8])
def test_parts_in_order_are_the_entity_whatever_its_records(spark, slices):
    """NULL entities and equal records included: the parts joined are the sorted value."""
    from cohortlens.operators import nested

    spark.conf.set("spark.sql.shuffle.partitions", str(slices))
    try:
        rows = [(None, i % 4, "n") for i in range(10)] + [("e", 5, "same")] * 12 + [("f", None, "x"), ("f", 1, None), ("g", 1, "y")]
        df = spark.createDataFrame(rows, "g string, k int, v string")
        res = nested.collect_sorted(df, "g", ["k", "v"], ["k"], per_part=3).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    parts = {}
    for r in sorted(res, key=lambda r: r["part"]):
        assert r["n"] == len(r["records"]) <= 3
        parts.setdefault(r["g"], []).append([tuple(x) for x in r["records"]])
    last = lambda x: (x is None, x)
    for g, own in parts.items():
        assert [len(p) for p in own[:-1]] == [3] * (len(own) - 1)
        assert sum(own, []) == sorted(((k, v) for h, k, v in rows if h == g), key=lambda r: (last(r[0])[0], r[0] or 0, last(r[1])[0], r[1] or ""))


def test_no_job_before_the_result_is_asked_for(spark, t):
    from cohortlens.operators import links, nested

    tracker, before = spark.sparkContext.statusTracker(), None
    before = set(tracker.getJobIdsForGroup(None))
    nested.joined_text(t.events, "user_id", "event_type", ["event_id"])
    ranking.serial_number(t.customer, [("c_custkey", True)])
    ranking.cume_dist_rows(t.customer, [("c_acctbal", False)])
    links.range_lookup(t.customer, "c_acctbal", links.cumulative_bounds(t.customer, "c_mktsegment"), "upper", "c_mktsegment")
    links.linked_rows(t.lineitem, "l_orderkey", "l_partkey", F.col("l_partkey") == 1, hops=3)
    assert set(tracker.getJobIdsForGroup(None)) == before


@pytest.mark.parametrize("order", [
    [("v", False), ("k", True)], [("v", True), ("k", True)], [("s", True), ("k", False)], [("s", False), ("k", True)],
    [("s", False), ("t", False)],
])
def test_first_value_by_equals_window(spark, order):
    from pyspark.sql import Window

    from cohortlens.operators.ranking import _sort_exprs, first_value_by

    rows = [(g, k, v, s, t) for g in range(3) for k, v, s, t in
            [(1, 5.0, "b", "x"), (2, None, "a", "y"), (3, 5.0, None, "z"), (4, -1.0, "c", None), (5, 7.0, "a", "y")]]
    df = spark.createDataFrame(rows, "g int, k int, v double, s string, t string")
    a = first_value_by(df, ["g"], "k", order, out="x")
    w = Window.partitionBy("g").orderBy(*_sort_exprs(order))
    b = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("g", F.col("k").alias("x"))
    assert sorted(a.collect()) == sorted(b.collect())


@pytest.mark.parametrize("frame", ["unbounded", "default"])
@pytest.mark.parametrize("asc", [False, True])
def test_nth_value_rows_equals_window(skewed, frame, asc):
    from pyspark.sql import Window

    from cohortlens.operators.ranking import nth_value_rows

    df = skewed.select("k", F.when(F.col("k") % 11 == 0, None).otherwise(F.col("v")).alias("v"))
    a = nth_value_rows(df, "v", 5, ascending=asc, frame=frame, out="x").select("k", "x")
    o = F.col("v").asc_nulls_last() if asc else F.col("v").desc_nulls_last()
    w = Window.orderBy(o)
    if frame == "unbounded":
        w = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    b = df.select("k", F.nth_value("v", 5).over(w).alias("x"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_first_value_by_nan_and_extreme_longs(spark):
    from pyspark.sql import Window

    from cohortlens.operators.ranking import _sort_exprs, first_value_by

    rows = [(1, 1, 3.0, -9223372036854775808), (1, 2, float("nan"), 5), (1, 3, None, 7), (2, 4, 1.0, 1), (2, 5, 1.0, 2)]
    df = spark.createDataFrame(rows, "g int, id int, v double, big long")
    for order in ([("v", False), ("id", True)], [("v", True), ("id", True)], [("big", False)], [("big", True), ("v", False)]):
        a = first_value_by(df, ["g"], "id", order, out="x")
        b = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*_sort_exprs(order)))).where(
            "rn = 1").select("g", F.col("id").alias("x"))
        assert sorted(a.collect()) == sorted(b.collect()), order


def test_cumulative_bounds_end_at_one(t):
    from cohortlens.operators import links

    got = [r["upper"] for r in links.cumulative_bounds(t.customer, "c_nationkey").orderBy("c_nationkey").collect()]
    sizes = [r["count"] for r in t.customer.groupBy("c_nationkey").count().orderBy("c_nationkey").collect()]
    assert got == [sum(sizes[: i + 1]) / sum(sizes) for i in range(len(sizes))] and got[-1] == 1.0


def test_stable_uniform_looks_random(spark):
    from cohortlens.functions.random import stable_uniform

    df = spark.range(1, 20001).select(stable_uniform("id", 0).alias("a"), stable_uniform("id", 1).alias("b"), stable_uniform(F.col("id").cast("string"), 0).alias("s"))
    rows = df.collect()
    a, b = [r["a"] for r in rows], [r["b"] for r in rows]
    assert a == [r["s"] for r in rows] and all(0 <= x < 1 for x in a) and len(set(a)) == len(a)
    assert len({round(y - x, 9) for x, y in zip(a, a[1:])}) > 19000  # no constant step
    top = lambda u: set(sorted(range(len(u)), key=u.__getitem__)[:100])
    assert len(top(a) & top(b)) < 10 and len({x - 1 for x in top(a)} & top(b)) < 10  # seeds are unrelated
    assert all(abs(sum(k / 10 <= x < (k + 1) / 10 for x in a) - 2000) < 250 for k in range(10))
    assert spark.range(1).select(stable_uniform(F.lit(None).cast("string")).alias("u")).first()["u"] is None
