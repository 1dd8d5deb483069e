"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Column | str


def _c(x: ColumnLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Euclid needs at most 92 remainder steps for 64-bit operands (Fibonacci
# bound); 47 suffice for 32-bit ones.
_EUCLID_STEPS_64 = 92


def gcd(a: ColumnLike, b: ColumnLike, steps: int = _EUCLID_STEPS_64) -> Column:
    """Greatest common divisor of two integer columns (bigint).

    Spark has no ``gcd``; this folds Euclid's step over a fixed-length
    sequence inside one JVM expression.  gcd(0, 0) = 0; signs are dropped.
    """
    start = F.struct(F.abs(_c(a).cast("bigint")).alias("x"), F.abs(_c(b).cast("bigint")).alias("y"))

    def step(acc: Column, _i: Column) -> Column:
        done = acc["y"] == 0
        return F.struct(
            F.when(done, acc["x"]).otherwise(acc["y"]).alias("x"),
            F.when(done, F.lit(0).cast("bigint")).otherwise(F.pmod(acc["x"], acc["y"])).alias("y"),
        )

    out = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)
    return out["x"]


def _exact_product(a: Column, b: Column) -> Column:
    """``a * b``, or an error beyond 64 bits whatever the session's ANSI mode."""
    product = F.try_multiply(a, b)
    missed = product.isNull() & a.isNotNull() & b.isNotNull()
    return F.when(missed, F.raise_error(F.lit("lcm: result is out of the 64-bit range")).cast("bigint")).otherwise(product)


def lcm(a: ColumnLike, b: ColumnLike) -> Column:
    """M6: least common multiple; 0 when either side is 0.  Beyond 64 bits it
    raises, as the reference's engine does."""
    g = gcd(a, b)
    aa, bb = F.abs(_c(a).cast("bigint")), F.abs(_c(b).cast("bigint"))
    return F.when(g == 0, F.lit(0).cast("bigint")).otherwise(_exact_product(F.call_function("div", aa, g), bb))


def parity(col: ColumnLike, even: str = "even", odd: str = "odd") -> Column:
    """M7: label by ``x % 2``; NULL stays NULL."""
    return F.when(F.pmod(_c(col), F.lit(2)) == 0, F.lit(even)).when(_c(col).isNotNull(), F.lit(odd))


def quotient(a: ColumnLike, b: ColumnLike) -> Column:
    """Integer quotient ``a div b`` truncated toward zero; NULL when b = 0."""
    aa, bb = _c(a).cast("bigint"), _c(b).cast("bigint")
    return F.when(bb != 0, F.call_function("div", aa, bb)).cast("bigint")


def remainder_capped(a: ColumnLike, b: ColumnLike) -> Column:
    """M9: ``a - least(a, b)``, 0 when b is 0 (the reference's letter)."""
    return F.when(_c(b) == 0, F.lit(0)).otherwise(_c(a) - F.least(_c(a), _c(b))).cast("bigint")


def safe_ratio(num: ColumnLike, den: ColumnLike) -> Column:
    """``num / den`` with NULL for a zero or NULL denominator."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def width_bin(col: ColumnLike, lo: float, hi: float, n: int) -> Column:
    """Equal-width bin number, 0 below ``lo`` and n+1 at/above ``hi``."""
    return F.width_bucket(_c(col).cast("double"), F.lit(float(lo)), F.lit(float(hi)), F.lit(n)).cast("bigint")


def with_gcd_lcm(
    df: DataFrame,
    a: ColumnLike,
    b: ColumnLike,
    *,
    gcd_out: str = "gcd",
    lcm_out: str | None = "lcm",
    unrolled: int = 10,
) -> DataFrame:
    """M6/D14 as a DataFrame transform, fast and exact.

    The first ``unrolled`` Euclid steps ``(x, y) -> (y, x mod y)`` are plain
    projections compiled by whole-stage codegen (kept short so the generated
    method stays small enough for the JIT).  By Lame's theorem they finish
    every pair whose smaller operand is below the Fibonacci number
    F(unrolled + 2) (89 for 10 steps); only the rare rows still running
    continue in :func:`gcd`'s fixed-length fold, evaluated lazily inside
    the CASE branch.
    """
    x, y = "_cl_gx", "_cl_gy"
    src_a, src_b = F.abs(_c(a).cast("bigint")), F.abs(_c(b).cast("bigint"))
    cur = df.withColumns({x: src_a, y: src_b})
    for _ in range(unrolled):
        done = F.col(y) == 0
        cur = cur.withColumns({
            x: F.when(done, F.col(x)).otherwise(F.col(y)),
            y: F.when(done, F.lit(0).cast("bigint")).otherwise(F.pmod(F.col(x), F.col(y))),
        })
    cur = cur.withColumn(gcd_out, F.when(F.col(y) == 0, F.col(x)).otherwise(gcd(x, y))).drop(x, y)
    if lcm_out:
        g = F.col(gcd_out)
        cur = cur.withColumn(
            lcm_out, F.when(g == 0, F.lit(0).cast("bigint")).otherwise(_exact_product(F.call_function("div", src_a, g), src_b))
        )
    return cur
