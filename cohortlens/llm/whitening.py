"""Embedding whitening by mixed-precision eigenvectors (operator 13).

Vectors become integers.  Spark adds them up exactly; with the sums, each task
centres its vectors at the rounded mean and multiplies them, so that every
partial product is a whole number and the sums over tasks are exact whatever
the order.  The covariance that follows, corrected for the rounding of the
mean, is one small table (dimensions squared, whatever the rows).

Its eigenvectors start in float32 and are refined by the iterations of Ogita and
Aishima: matrix products alone, here in extended precision, double the right
digits each time.  Eigenvalues that lie too close for the iteration to part
form a cluster: the eigenproblem of the matrix projected on the cluster's
vectors, less their mean eigenvalue, is solved by itself, and the iteration
goes on with the parted vectors.

A further pass takes the covariance of the whitened values that are returned.

Cases: vectors that are null, empty or hold null or non-finite entries are
dropped, also those whose length is not the commonest (of equally common
lengths the longest is kept); a null ``vec_id`` is returned as it is and
repeated rows count each; a component without variance (equal vectors, one
vector, fewer vectors than components) has ``whitened`` 0 and stays out of
``identity_error``, and without any variance ``explained`` is 0; ``deviation`` is
null where it exceeds a long; an empty table gives an empty result; columns
other than ``vec_id`` and ``embedding`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import written

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Vectors multiplied at a time: products stay whole numbers below 2^53 for
#: centred entries up to 2^20.
BATCH = 4096
#: Entries beyond this (after scaling) count as this.
EDGE = float(2**62)


# --- the eigenproblem -----------------------------------------------------------


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Positions of eigenvalues no further apart than ``gap`` from the next."""
    order = np.argsort(-values)
    cuts = np.flatnonzero(-np.diff(values[order]) > gap) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def refine(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One iteration: eigenvalues, better eigenvectors, and the distance below
    which eigenvalues counted as equal.  ``a`` and ``x`` are in the precision
    of the iteration."""
    r = np.eye(len(a), dtype=a.dtype) - x.T @ x
    s = x.T @ a @ x
    s = (s + s.T) / 2  # else rounding, divided by a small gap, bends the right angle
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    norm = lambda m: np.sqrt((m * m).sum())
    gap = 2 * (norm(off) + norm(a) * norm(r))
    apart = values[None, :] - values[:, None]
    far = np.abs(apart) > gap
    e = np.where(far, (s + values[None, :] * r) / np.where(far, apart, 1), r / 2)
    return values, x + x @ e, float(gap)


def eigenvectors(a: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric
    matrix, which is scaled by its largest entry on the way."""
    a = np.asarray(a, np.longdouble)
    scale = np.abs(a).max() if a.size else 0
    if scale == 0:
        return np.zeros(len(a)), np.eye(len(a))
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    fine = np.finfo(np.longdouble).eps * len(a)
    last = np.inf
    for _ in range(rounds):
        values, x, gap = refine(a, x)
        for c in _clusters(np.asarray(values, np.float64), gap):
            x[:, c] = _parted(a, x[:, c])
        if gap <= 16 * fine or gap >= last / 2:  # as good as the precision allows
            break
        last = gap
    values, x, _ = refine(a, x)
    x = x / np.sqrt((x * x).sum(axis=0))
    values = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    sign = np.sign(x[np.abs(x).argmax(axis=0), np.arange(x.shape[1])])
    return np.asarray(values[order] * scale, np.float64), np.asarray(x * np.where(sign == 0, 1, sign), np.float64)


def _parted(a: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The basis of a cluster turned to its eigenvectors: the projected matrix
    less its mean eigenvalue has the cluster's differences in full precision."""
    # the basis is orthonormal up to what the iteration has reached: two steps of Newton's make it so
    for _ in range(2):
        basis = basis @ (1.5 * np.eye(basis.shape[1], dtype=basis.dtype) - 0.5 * (basis.T @ basis))
    mean = np.trace(basis.T @ a @ basis) / basis.shape[1]
    small = basis.T @ (a @ basis - mean * basis)
    small = (small + small.T) / 2
    size = np.abs(small).max()
    if size == 0:
        return basis
    return basis @ np.linalg.eigh(np.asarray(small / size, np.float64))[1].astype(np.longdouble)


# --- the jobs ---------------------------------------------------------------------


def integer_vectors(rows: DataFrame) -> DataFrame:
    """``(vec_id, x array<long>)`` of the vectors that remain."""
    c = F.col("embedding")
    sound = F.size(c) > 0
    sound &= ~F.exists(c, lambda e: e.isNull() | F.isnan(e.cast("double")) | (F.abs(e.cast("double")) == F.lit(float("inf"))))
    kept = rows.select("vec_id", "embedding").where(c.isNotNull() & sound)
    lengths = kept.groupBy(F.size(c).alias("d")).count().agg(F.max_by("d", F.struct("count", "d")).alias("d"))
    scaled = F.transform(c, lambda e: F.floor(F.greatest(F.least(F.lit(SCALE) * e.cast("double"), F.lit(EDGE)), F.lit(-EDGE))).cast("long") + F.lit(SHIFT))
    return kept.where(F.size(c) == lengths.scalar()).select("vec_id", scaled.alias("x"))


def _matrix(x: pa.Array) -> np.ndarray:
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, BATCH):
            yield b.slice(at, BATCH)


def sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum per dimension."""
    per = vectors.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.count("*").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s"))
    rows = sorted(per.collect(), key=lambda r: r["i"])  # a row a dimension
    return (rows[0]["n"] if rows else 0), [int(r["s"]) for r in rows]


def products(vectors: DataFrame, centre: list[int]) -> list[list[int]]:
    """Exact sums of the products of vectors centred at ``centre``."""
    d, at = len(centre), np.array(centre, np.int64)

    def rows(limb: int, values: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([limb] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array(list(values), pa.list_(pa.int64()))], ["limb", "i", "p"])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), np.int64)
        for b in _slices(batches):
            x = _matrix(b.column(0))
            z = x.astype(np.float64) - at
            part = z.T @ z
            if np.abs(part).max() < 2**53:
                if np.abs(total).max() >= 2**62:
                    yield rows(0, total)
                    total = np.zeros((d, d), np.int64)
                total += part.astype(np.int64)
                continue
            # entries far beyond any embedding: whole numbers of any size, sent in pieces of 32 bits
            far = x.astype(object) - at.astype(object)
            rest, limb = far.T.dot(far), 0
            while (rest != 0).any():
                yield rows(limb, (rest & 0xFFFFFFFF).astype(np.int64))
                rest, limb = rest >> 32, limb + 1
                if limb == 5:  # the sign
                    yield rows(limb, rest.astype(np.int64))
                    break
        if total.any():
            yield rows(0, total)

    parts = vectors.select("x").mapInArrow(multiply, "limb int, i int, p array<long>")
    per = parts.select("limb", "i", F.posexplode("p").alias("j", "v")).groupBy("limb", "i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    out = [[0] * d for _ in range(d)]
    for r in per.collect():  # a row a pair of dimensions
        out[r["i"]][r["j"]] += int(r["v"]) << (32 * r["limb"])
    return out


def covariance(n: int, s: list[int], centre: list[int], p: list[list[int]]) -> np.ndarray:
    """Of integers, divisor ``n``, in extended precision: the products around
    the centre less those of its distance from the mean, one rounding each."""
    off = [Fraction(t, n) - c for t, c in zip(s, centre, strict=True)]
    out = np.zeros((len(s), len(s)), np.longdouble)
    for i, row in enumerate(p):
        for j, v in enumerate(row):
            exact = Fraction(v, n) - off[i] * off[j]
            high = float(exact)
            out[i, j] = np.longdouble(high) + np.longdouble(float(exact - Fraction(high)))
    return out


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained,
    identity_error)`` of ``rows (vec_id, embedding)``."""
    vectors = written(integer_vectors(rows), "vectors")
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double"
    n, s = sums(vectors)
    if not n:
        return rows.sparkSession.createDataFrame([], schema + ", identity_error double")
    centre = [round(Fraction(t, n)) for t in s]
    v = covariance(n, s, centre, products(vectors, centre))
    values, axes = eigenvectors(v)
    trace = float(np.trace(v))
    k = min(components, len(s))
    real = values[:k] > max(trace, 0) * 1e-13  # below it is what rounding leaves of a missing rank
    values, axes = np.where(real, values[:k], 0), axes[:, :k]
    scale = np.where(real, 1 / np.sqrt(np.where(real, values, 1)), 0)
    explained = values / trace if trace > 0 else np.zeros(k)
    # x - S/n = (x - centre) - off, both parts without a loss of digits
    at, off = np.array(centre, np.int64), np.array([float(Fraction(t, n) - c) for t, c in zip(s, centre, strict=True)])
    rest = np.array([t - n * c for t, c in zip(s, centre, strict=True)], object)

    def projected(x: np.ndarray) -> np.ndarray:
        return (((x - at).astype(np.float64) - off) @ axes) * scale

    def deviations(x: np.ndarray) -> list:
        z = x - at
        bound = n * (float(np.abs(z).max()) + 1) if len(z) else 0.0
        if bound * bound * len(centre) < 2**62:  # whole numbers that fit
            y = n * z - rest.astype(np.int64)
            return (y * y).sum(axis=1).tolist()
        exact = [sum((n * int(e) - int(r)) ** 2 for e, r in zip(row, rest, strict=True)) for row in z]
        return [e if e < 2**63 else None for e in exact]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((k + 1, k)), False
        for b in _slices(batches):
            w = projected(_matrix(b.column(0)))
            total[:k] += w.T @ w
            total[k] += w.sum(axis=0)
            seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(range(k + 1), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "p"])

    parts = vectors.select("x").mapInArrow(spread, "i int, p array<double>").select("i", F.posexplode("p").alias("j", "v"))
    got = np.zeros((k + 1, k))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # a row a pair of components
        got[r["i"], r["j"]] = r["v"] / n
    error = np.abs(got[:k] - np.outer(got[k], got[k]) - np.eye(k))[np.ix_(real, real)]

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            x, each = _matrix(b.column("x")), np.repeat(np.arange(b.num_rows), k)
            columns = [
                b.column("vec_id").take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(each), n)),
                pa.array(deviations(x), pa.int64()).take(pa.array(each)),
                pa.array(projected(x).ravel()),
                pa.array(np.tile(explained, len(x))),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained"])

    out = vectors.mapInArrow(results, schema)
    return out.withColumn("identity_error", F.lit(float(error.max()) if error.size else 0.0))
