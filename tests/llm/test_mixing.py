"""Mixing against DuckDB, a linear-programming-free plain check of the flow, and odd rows."""

import itertools

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlens.llm import mixing as M
from cohortlens.llm.queries import ORACLES, QUERIES
from tests.llm.oracle import same

SF = "/root/testdata/sf0.01"


def test_query_equals_duckdb(spark):
    out = same(spark, QUERIES["op4_source_mixing"], ORACLES["op4_source_mixing"], SF)
    assert (out["taken"] <= 3 * out["size"]).all()


def test_words_taken_come_near_the_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = M.mix(docs).join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken").alias("n"), F.max("target").alias("t"), F.max("size").alias("m"), F.sum("size").alias("c"), F.max("source_size").alias("c2")).collect()
    assert all(abs(r.n - r.t) <= r.m and r.c == r.c2 for r in out)
    assert abs(sum(r.t for r in out) - sum(r.c for r in out)) < 1


def test_targets_stop_at_three_times_the_source():
    t = M.targets({"a": 10, "b": 1000, "c": 1000}, {"a": 5, "b": 2, "c": 1}, 2010)
    assert t["a"] == 30 and t["b"] == pytest.approx(1320) and t["c"] == pytest.approx(660)
    assert sum(M.targets({"a": 0, None: 7}, {"a": 1, None: 2}, 7).values()) == pytest.approx(7)


def best(capacity, members, demand, repeat=3):
    """Fullest flow and its least cost, over all integer flows."""
    arcs = [(p, s) for p in capacity for s in members[p]]
    top = (-1, 0)
    for f in itertools.product(*[range(min(repeat * capacity[p], demand[s]) + 1) for p, s in arcs]):
        out = {p: sum(x for x, (q, _) in zip(f, arcs) if q == p) for p in capacity}
        got = {s: sum(x for x, (_, q) in zip(f, arcs) if q == s) for s in demand}
        if all(out[p] <= repeat * capacity[p] for p in out) and all(got[s] <= demand[s] for s in got):
            top = max(top, (sum(f), -cost(out, capacity)))
    return top


def cost(out, capacity):
    """The k-th pass over a word costs k squared."""
    return sum(min(max(out[p] - k * c, 0), c) * (k + 1) ** 2 for p, c in capacity.items() for k in range(3))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=3, max_size=3), st.lists(st.integers(0, 5), min_size=2, max_size=2))
def test_flow_is_fullest_and_cheapest(caps, needs):
    members = {"p": ["a"], "q": ["a", "b"], "r": ["b"]}
    capacity, demand = dict(zip("pqr", caps)), dict(zip("ab", needs))
    flow = M.route(capacity, members, demand)
    out = {p: sum(flow.get((p, s), 0) for s in "ab") for p in capacity}
    assert all(sum(flow.get((p, s), 0) for p in capacity) <= demand[s] for s in demand)
    assert (sum(out.values()), -cost(out, capacity)) == best(capacity, members, demand)


def test_overlapping_sources_share_documents(spark):
    rows = [(i, ["a"], 10) for i in range(100)] + [(i, ["a", "b"], 10) for i in range(100, 200)] + [(i, ["b", None], 10) for i in range(200, 240)]
    docs = spark.createDataFrame(rows, "doc_id long, members array<string>, size long")
    slim = docs.select(M.pattern(F.col("members")).alias("pattern"), M.order_key(F.col("doc_id"), F.col("size"), 1).alias("key"))
    plan = M.make_plan(slim, {"a": 1, "b": 8, None: 1}, total=2400)
    for s, t in plan.target.items():
        assert sum(v for (_, x), v in plan.flow.items() if x == s) == pytest.approx(min(t, 2400), abs=1200)
    assert sum(plan.flow.values()) >= 2390


def given_words(out):
    got, target = {}, {}
    for r in out:
        assert sum(g.taken for g in r.given) == pytest.approx(r.taken) and r.taken <= 3 * r["size"]
        for g in r.given:
            got[g.source] = got.get(g.source, 0) + g.taken
            target[g.source] = g.target
    return got, target


def test_rows_of_overlapping_sources_meet_every_target(spark):
    members = lambda i: ["a"] if i < 100 else ["b", "a", "b"] if i < 200 else ["b", None]
    docs = spark.createDataFrame([(i, "w " * 10, members(i)) for i in range(240)], "doc_id long, text string, source array<string>")
    weights = {"a": 1, "b": 8, None: 1}
    got, target = given_words(M.mix(docs, weights).collect())
    assert target == pytest.approx({"a": 240, "b": 1920, None: 240})
    assert all(abs(got[s] - target[s]) <= 10 for s in target)  # one document
    times = M.mixed_rows(docs, weights=weights).groupBy("doc_id").count().collect()
    taken = {r.doc_id: r.taken for r in M.mix(docs, weights).collect() if r.taken}
    assert taken == {r.doc_id: 10 * r["count"] for r in times}


def test_sources_in_several_columns(spark):
    rows = [(i, "w " * 10, "x" if i % 2 else None, "y" if i % 3 else None) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, s1 string, s2 string")
    as_array = docs.select("doc_id", "text", F.array_compact(F.array("s1", "s2")).alias("source"))
    by_columns = sorted(M.mix(docs, sources=["s1", "s2"]).collect(), key=str)
    assert by_columns == sorted(M.mix(as_array).collect(), key=str)
    got, target = given_words(by_columns)
    assert set(target) == {"x", "y", None} and all(abs(got[s] - target[s]) <= 10 for s in target)
    assert M.mixed_rows(docs, source_col=["s1", "s2"]).columns == docs.columns
    empty = docs.where("false")
    assert M.mix(empty, sources=["s1", "s2"]).count() == 0 and M.mixed_rows(empty, source_col=["s1", "s2"]).count() == 0
    odd = spark.createDataFrame([(1, "a b", None), (2, "a b", []), (None, None, [None, "x"]), (3, "a", ["x", "x"])], "doc_id long, text string, source array<string>")
    named = {r.doc_id: [g.source for g in r.given] for r in M.mix(odd).collect()}
    assert named == {1: [None], 2: [None], None: ["x", None], 3: ["x"]}


@pytest.mark.parametrize("range_rows", [1, 7, 2000])
def test_seeded_choice_is_the_same_for_any_range_and_partitioning(spark, monkeypatch, range_rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = sorted(map(tuple, M.mix(docs).collect()))
    monkeypatch.setattr(M, "RANGE_ROWS", range_rows)
    assert sorted(map(tuple, M.mix(docs.repartition(5)).collect())) == want


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, empty):
    rows = [(1, None, None, "x"), (2, "", "a", "x"), (None, "one two", "a", None), (3, "w " * 40000, "b", "y"), (4, "a b c", None, "z"), (4, "a b c", None, "z"), (5, " \n", "null", "z")]
    docs = spark.createDataFrame([] if empty else rows, "doc_id long, text string, source string, size string")
    out = M.mix(docs.drop("size")).collect()
    assert len(out) == (0 if empty else 7) and all(r.taken <= 3 * r["size"] for r in out)
    assert len({r.taken for r in out if r.doc_id == 4}) == (0 if empty else 1)
    kept = M.mixed_rows(docs)
    assert kept.columns == docs.columns
    times = {}
    for r in kept.collect():
        times[r.doc_id, r.text] = times.get((r.doc_id, r.text), 0) + 1
    taken = {}
    for r in out:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    assert taken.get(3, 0) == 40000 * times.get((3, "w " * 40000), 0)
