"""The shingle join against DuckDB, all pairs, and hostile groups."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import ngram_join as J
from cohortlens.llm.queries import ORACLES, QUERIES
from tests.llm.oracle import same

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string"


def plain(rows):
    """All pairs."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links = [[j for j in range(len(rows)) if j != i and sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(len(rows))]
    out = []
    for i, (d, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        low = min((rows[j][0] for j in seen))
        out.append((d, len(sets[i]), min(rows[j][0] for j in range(len(rows)) if j == i or (sets[i] and sets[j] == sets[i])), len(links[i]), low, d == low))
    return sorted(out)


def corpus(seed=2):
    """Chains of near copies, exact copies, and one passage in a third of all texts."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(60)]
    texts = []
    for g in range(25):
        base = [word() for _ in range(r.choice([3, 5, 20, 80, 200]))]
        if g % 3 == 0:
            base[2:2] = passage
        for _ in range(r.choice([1, 2, 3, 14])):
            texts.append(" ".join(base))
            base = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 60))):
                base[r.randrange(len(base))] = word()
    texts += [" ".join(passage + [word() for _ in range(r.choice([3, 10, 40]))]) for _ in range(60)] + ["one two", "one two", "one  two\n"]
    r.shuffle(texts)
    return list(enumerate(texts))


def test_query_equals_duckdb(spark):
    out = same(spark, QUERIES["op6_ngram_jaccard_join"], ORACLES["op6_ngram_jaccard_join"], SF)
    assert (out["n_links"] > 0).sum() > 50


@pytest.mark.parametrize("leaf,bucket_block,group_block", [(400, 2000, 800), (3, 5, 4), (12, 2000, 9)])
def test_splitting_and_blocks_lose_no_link(spark, leaf, bucket_block, group_block):
    rows = corpus()
    out = J.join(spark.createDataFrame(rows, SCHEMA), leaf=leaf, bucket_block=bucket_block, group_block=group_block).collect()
    assert sorted(map(tuple, out)) == plain(rows)


def test_hot_group_is_settled_in_blocks(spark):
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(base[: i % 150] + [f"x{i}"] + base[i % 150 + 1 :])) for i in range(300)]
    out = J.join(spark.createDataFrame(rows, SCHEMA), leaf=20, bucket_block=64, group_block=50).collect()
    assert sorted(map(tuple, out)) == plain(rows)


def test_runs_reach_the_recall():
    assert J.runs_for(0.9) < J.runs_for() <= 5
    rng = np.random.default_rng(3)
    met = 0
    for _ in range(2000):
        shared, a, b = (_rand(rng, n) for n in (80, 10, 10))  # similarity 0.8
        x, y = np.sort(np.concatenate([shared, a])), np.sort(np.concatenate([shared, b]))
        met += any(np.isin(J.picks(x[: J.SAMPLE], r, 0), J.picks(y[: J.SAMPLE], r, 0)).any() for r in range(J.runs_for()))
    assert met == 2000


def _meets(x, y, run, depth, level=0):
    """Whether two samples share a path of ``depth`` levels."""
    a, b = J.picks(x, run, level), J.picks(y, run, level)
    return any(level + 1 == depth or _meets(x[x != t], y[y != t], run, depth, level + 1) for t in a[np.isin(a, b)])


@pytest.mark.parametrize("depth,loss", [(1, 5e-5), (2, 2e-4), (4, 1e-3)])
def test_contained_pairs_keep_their_recall_over_levels(depth, loss):
    rng, missed = np.random.default_rng(7), []
    for _ in range(150):
        small = _rand(rng, 400)  # similarity 0.8 to the larger set
        x, y = np.sort(small)[: J.SAMPLE], np.sort(np.concatenate([small, _rand(rng, 100)]))[: J.SAMPLE]
        missed.append(np.mean([not _meets(x, y, run, depth) for run in range(24)]))
    assert np.mean(np.array(missed) ** J.runs_for()) <= loss


def test_large_near_copy_group_is_not_compared_with_itself(spark):
    """Rows dealt to comparisons grow with the group, not its square."""
    dealt = {}
    for m in (400, 800):
        rng = np.random.default_rng(8)
        base = _rand(rng, 300)
        sets = [np.unique(np.concatenate([np.delete(base, i % 300), _rand(rng, 1)])) for i in range(m)]
        rows = [(J.digest(s), len(s), J.minhash_bits(s), 7, 0, b"") for s in sets]
        hot = spark.createDataFrame(rows, "node binary, n int, bits binary, path long, run int, used binary")
        folded = J._folded(hot, J._heads(hot))
        assert folded.where("lead < 0").count() == 0 and folded.where("lead = 0").count() > 0.99 * m
        facts = folded.groupBy("path").agg(F.count_if(F.col("lead") == 0).alias("most"), F.count_if(F.col("lead") != 0).alias("rest"), F.lit(0).alias("major"))
        dealt[m] = J._units(folded.join(facts, "path"), 50).count()
    assert dealt[800] <= 2 * dealt[400] + 32
    # three strangers in the bucket still meet every row
    extra = spark.createDataFrame([(J.digest(s), len(s), J.minhash_bits(s), 7, 0, b"", -1, None) for s in (_rand(rng, 300) for _ in range(3))], folded.schema)
    facts = spark.createDataFrame([(7, 800, 3, 0)], "path long, most long, rest long, major int")
    units = J._units(folded.withColumn("lead", F.lit(0)).union(extra).join(facts, "path"), 50)
    got = units.groupBy("bi", "bj").agg(F.count_if(F.col("blk") == F.col("bi")).alias("a"), F.count_if(F.col("blk") == F.col("bj")).alias("b")).where("bi = 0").collect()
    assert {r.bj for r in got} == set(range(17)) and sum(r.b for r in got if r.bj) == 800 and all(r.a == 3 for r in got)


def _rand(rng, n):
    return rng.integers(0, 1 << 63, n, np.uint64)


def test_sketch_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(4)
    for _ in range(2000):
        shared, a, b = (_rand(rng, n) for n in (80, 10, 10))
        s = [np.frombuffer(J.minhash_bits(np.concatenate([shared, v])), np.uint64)[None] for v in (a, b)]
        assert J._alike(s[0], s[1], np.array([90]), np.array([90])).all()


def test_overlaps():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 40, n).astype(np.uint64)) for n in (5, 9, 30, 1, 12, 20)]
    want = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    got = J.overlaps(sets, 6, True)
    assert (np.triu(got, 1) == np.triu(want, 1)).all() and (J.overlaps(sets, 2, False) == want[:2, 2:]).all()
    assert (J.overlaps(sets[:2], 1, False) == want[:1, 1:2]).all()


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, empty):
    long = "a b c d e f g " * 20000
    rows = [(1, None, 1, "x"), (2, "", 1, "x"), (None, "p q r s t u", 1, "x"), (None, "p q r s t u", 1, "x"), (5, long, None, None), (6, long + "z", 3, "y"), (7, "p q r s t u", 1, "z"), (7, "p q r s t u", 1, "z"), (8, "other words", 2, "x"), (None, "none at all here", 5, "w")]
    docs = spark.createDataFrame([] if empty else rows, "doc_id long, text string, n_links long, node string")
    out = sorted(((r.doc_id or 0, r.n_links, r.component_id, r.kept) for r in J.join(docs).collect()), key=str)
    want = [(0, 3, 7, False), (0, 3, 7, False), (0, 0, None, True), (1, 0, 1, True), (2, 0, 2, True), (5, 1, 5, True), (6, 1, 5, False), (7, 3, 7, True), (7, 3, 7, True), (8, 0, 8, True)]
    assert out == sorted([] if empty else want, key=str)
    left = J.one_of_each(docs)
    assert left.columns == docs.columns
    got = sorted((tuple(r) for r in left.collect()), key=str)
    assert got == sorted([] if empty else [rows[0], rows[1], rows[4], rows[6], rows[8], rows[9]], key=str)
