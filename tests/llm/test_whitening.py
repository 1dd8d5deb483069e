"""Whitening against exact sums and eigenvectors of a plain solver, with
clustered, equal and missing eigenvalues."""

import math
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest

from cohortlens.llm import whitening as W
from cohortlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>"


def plain(vectors):
    """Integers, deviations and covariance (by fractions) of sound vectors."""
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    dev = [sum((n * r[i] - s[i]) ** 2 for i in range(d)) for r in x]
    y = np.array([[n * r[i] - s[i] for i in range(d)] for r in x], object)
    cov = y.T.dot(y)
    return x, n, s, dev, np.array([[float(Fraction(int(c), n**3)) for c in row] for row in cov])


def check(rows, vectors, tolerance=1e-9):
    x, n, s, dev, cov = plain([v for _, v in vectors])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(8, len(s))
    assert len(rows) == len(vectors) * k
    got = {}
    for r in rows:
        got.setdefault(r.component, {})[r.vec_id] = r
    place = {vec_id: i for i, (vec_id, _) in enumerate(vectors)}
    centred = np.array([[float(Fraction(n * r[i] - s[i], n)) for i in range(len(s))] for r in x])
    for c in range(1, k + 1):
        own = np.array([got[c][vec_id].whitened for vec_id, _ in vectors])
        want = centred @ axes[:, c - 1] / math.sqrt(values[c - 1])
        sign = 1 if own @ want > 0 else -1
        assert np.abs(own * sign - want).max() < tolerance
        r = next(iter(got[c].values()))
        assert r.n == n and abs(r.explained / (values[c - 1] / np.trace(cov)) - 1) < 1e-9 and r.identity_error < 1e-9
        assert all(q.deviation == dev[place[i]] for i, q in got[c].items())


def test_query_against_a_plain_solver(spark):
    rows = QUERIES["op13_embedding_whitening"](spark, SF).collect()
    given = pq.read_table(f"{SF}/embeddings.parquet", columns=["vec_id", "embedding"]).to_pylist()
    check(rows, [(r["vec_id"], r["embedding"]) for r in given], 1e-7)


def orthogonal(rng, d):
    return np.linalg.qr(rng.normal(size=(d, d)))[0]


@pytest.mark.parametrize("values", [
    [9, 5, 3, 2, 1, 0.5],
    [1 + 1e-9, 1, 1 - 1e-9, 0.5, 0.5 - 1e-10, 0.1],  # clusters float32 cannot part
    [4, 4, 4, 1, 1, 1],
    [1e6, 1, 1 - 1e-7, 1e-6, 1e-6 - 1e-13, 0],
    [1 + 3e-12, 1, 1e-3, 1e-3 - 1e-14, 1e-9, 0],
])
def test_refined_eigenvectors(values):
    rng = np.random.default_rng(4)
    q = orthogonal(rng, 6).astype(np.longdouble)
    for _ in range(3):  # orthonormal in extended precision
        q = q @ (1.5 * np.eye(6, dtype=np.longdouble) - 0.5 * (q.T @ q))
    v = np.array(values, np.longdouble)
    a = (q * v) @ q.T
    got, axes = W.eigenvectors((a + a.T) / 2)
    assert np.abs(got - np.sort(np.array(values, float))[::-1]).max() < 1e-15 * max(values)
    assert np.abs(axes.T @ axes - np.eye(6)).max() < 1e-14
    assert np.abs(a @ axes - axes * got).max() < 4e-15 * max(values)
    for i in range(6):  # a distinct eigenvalue's vector is the planted one, up to its conditioning
        gap = min(abs(values[i] - values[j]) for j in range(6) if j != i)
        if gap > 0:
            assert np.abs(np.abs(axes[:, i]) - np.abs(q[:, i].astype(float))).max() < 1e-15 + 1000 * np.finfo(np.longdouble).eps * max(values) / gap


def test_float32_alone_is_not_enough():
    rng = np.random.default_rng(4)
    q = orthogonal(rng, 6)
    a = (q * np.array([1 + 1e-9, 1, 1 - 1e-9, 0.5, 0.4, 0.1])) @ q.T
    rough = np.linalg.eigh(((a + a.T) / 2).astype(np.float32))[1].astype(float)
    fine = W.eigenvectors((a + a.T) / 2)[1]
    off = lambda x: np.abs(x.T @ a @ x - np.diag(np.diag(x.T @ a @ x))).max()
    assert off(fine) < 1e-15 < 1e-9 < off(rough)


def test_sums_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(2)
    vectors = [(i, [float(np.float32(v)) for v in rng.normal(size=5)]) for i in range(400)]
    one = sorted(map(tuple, W.whiten(spark.createDataFrame(vectors, SCHEMA).coalesce(1)).drop("identity_error").collect()))
    many = sorted(map(tuple, W.whiten(spark.createDataFrame(vectors, SCHEMA).repartition(13)).drop("identity_error").collect()))
    assert [r[:4] for r in one] == [r[:4] for r in many] and np.allclose([r[4:] for r in one], [r[4:] for r in many], rtol=0, atol=1e-12)
    check(W.whiten(spark.createDataFrame(vectors, SCHEMA)).collect(), vectors)


def test_huge_entries_stay_exact(spark):
    schema = "vec_id long, embedding array<double>"
    vectors = [(i, [float(v) for v in row]) for i, row in enumerate([[2.0**40, 1], [-(2.0**41), 5], [3.0, 2.0**38], [7.5, 2]])]
    x, n, s, _, _ = plain([v for _, v in vectors])
    df = W.integer_vectors(spark.createDataFrame(vectors, schema)).repartition(3)
    assert W.sums(df) == (n, s)
    c = [round(Fraction(t, n)) for t in s]
    assert W.products(df, c) == [[sum((r[i] - c[i]) * (r[j] - c[j]) for r in x) for j in range(2)] for i in range(2)]
    got = {r.vec_id: r for r in W.whiten(df.sparkSession.createDataFrame(vectors, schema)).where("component = 1").collect()}
    assert got[0].deviation is None and len(got) == 4  # beyond a long


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, empty):
    nan, inf = float("nan"), float("inf")
    sound = [(1, [1.0, 2.0, 0.5]), (2, [0.0, 1.0, 0.25]), (3, [0.5, 0.1, 0.7]), (4, [-1.0, 0.2, 0.3]), (5, [0.0, 0.0, 0.0])]
    rows = [(*r, 1) for r in sound] + [(6, None, 1), (7, [], 1), (8, [1.0, None, 1.0], 1), (9, [nan, 1.0, 1.0], 1), (10, [1.0, -inf, 1.0], 1), (11, [1.0, 1.0], 1)]
    got = W.whiten(spark.createDataFrame([] if empty else rows, SCHEMA + ", n int")).collect()
    if empty:
        assert got == []
        return
    check(got, sound)
    twice = W.whiten(spark.createDataFrame([(None, [1.0, 2.0]), (3, [1.0, 2.0]), (3, [1.0, 2.0])], SCHEMA)).collect()
    assert sorted((r.vec_id is None, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in twice) == sorted((a, c, 3, 0, 0.0, 0.0, 0.0) for a in (True, False, False) for c in (1, 2))
    line = W.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [3.0, 6.0])], SCHEMA)).collect()  # rank one
    assert all(r.whitened == 0 and r.explained == 0 for r in line if r.component == 2) and max(r.identity_error for r in line) < 1e-12
