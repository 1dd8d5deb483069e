"""Ranking, n-th values, tiles and samples (W1-W6, W9-W10, L2-L7, section 4.3).

A window ``OVER (ORDER BY x)`` without a partition makes Spark move every
row into one task.  Over raw rows that does not scale, so the ranking
operators here use :func:`ordered_index`, which computes the same running
counts from buckets of the order:

1. The order columns become one value (:func:`order_key`) that compares in the
   declared order: NULL flags, directions and text prefixes are part of it.
2. A scalar subquery sorts the keys of a seeded sample, some a bucket, and
   cuts them into boundaries.  A row's bucket is the number of boundaries
   ahead of its key, found by halving steps that are plain column
   expressions.  It is a pure function of the key: retries and re-plans give
   the same bucket, nothing is checkpointed, and nothing runs before the
   result is asked for.
3. A small aggregate gives the weight of every (bucket, group) pair, and a
   window over those pairs each bucket's offset within its group; a hot group
   spread over many buckets has at most one row per bucket there.
4. A window partitioned by (bucket, group) adds the local running sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.operators._util import join_null_safe

OrderSpec = Sequence[tuple[str, bool]]  # (column, ascending)

_BUCKET = "_cl_bucket"
#: Sampled keys per bucket; the sample holds about this many times the buckets.
SAMPLE_PER_BUCKET = 16
#: Code points of a text that take part in finding its bucket.
TEXT_PREFIX = 64
_HEX, _FLIPPED = "0123456789ABCDEF", "FEDCBA9876543210"


def _sort_exprs(order: OrderSpec) -> list[Column]:
    # nulls always last (D3), in both directions
    return [F.col(c).asc_nulls_last() if asc else F.col(c).desc_nulls_last() for c, asc in order]


def _key_fields(c: Column, kind: T.DataType, asc: bool) -> list[Column]:
    """Columns that, compared one after the other in Spark's own ascending order,
    put values of ``c`` in the declared order, NULLs last.  Texts count by a
    prefix: a coarser order, which is all that a bucket needs."""
    if isinstance(kind, T.StringType):
        c = F.substring(c, 1, TEXT_PREFIX)
    if asc:
        return [c.isNull(), c]
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        down = [~F.isnan(c), -c]  # NaN is the largest value
    elif isinstance(kind, T.IntegralType):
        down = [F.bitwise_not(c)]  # unlike a negation it cannot overflow
    elif isinstance(kind, T.DecimalType):
        down = [-c]
    elif isinstance(kind, T.BooleanType):
        down = [~c]
    elif isinstance(kind, T.DateType):
        down = [F.bitwise_not(F.unix_date(c))]
    elif isinstance(kind, T.TimestampType):
        down = [F.bitwise_not(F.unix_micros(c))]
    elif isinstance(kind, T.TimestampNTZType):
        down = [F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") - c]
    elif isinstance(kind, (T.StringType, T.BinaryType)):
        # digits of the bytes turned round, and an end that comes after every digit
        down = [F.concat(F.translate(F.hex(c), _HEX, _FLIPPED), F.lit("G"))]
    else:
        raise ValueError(f"cannot order {kind.simpleString()} downwards")
    return [c.isNull(), *down]


def order_key(df: DataFrame, order: OrderSpec) -> Column:
    """The order columns of a row as one struct; ``<`` on it is the declared
    order (of texts, that of their prefixes)."""
    fields = [f for c, asc in order for f in _key_fields(F.col(c), df.schema[c].dataType, asc)]
    return F.struct(*[f.alias(f"k{i}") for i, f in enumerate(fields)])


def _digit(low: str, place: int, base: int) -> str:
    """How many of the boundaries at ``low + place * 1, 2, ... base - 1`` are
    ahead of the key: a tree of comparisons, no more than its depth for a row."""

    def tree(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi + 1) // 2  # beyond the last boundary the comparison is NULL
        return f"CASE WHEN get(_cl_bounds, {low} + {mid * place - 1}) < _cl_key THEN {tree(mid, hi)} ELSE {tree(lo, mid - 1)} END"

    return f"CAST({low} + {place} * {tree(0, base - 1)} AS INT)"


def order_bucket(df: DataFrame, order: OrderSpec, buckets: int, weight: str | None = None, *extra: Column) -> DataFrame:
    """Add ``_cl_bucket``: the row's place among at most ``buckets`` ranges of
    ``order``, ascending with it; equal keys share a bucket.  With ``weight``,
    the sample draws rows in proportion to it, and every branch of the plan
    reads the same columns, so an aggregate below is exchanged once.
    ``extra`` columns are added on the way."""
    keyed = df.select("*", order_key(df, order).alias("_cl_key"))
    w = f"CAST({weight} AS DOUBLE)" if weight else "1.0D"
    rows = keyed.agg(F.expr(f"sum({w})")).scalar()
    draw = F.expr("pmod(xxhash64(_cl_key), 1099511627776)") * rows < F.expr(f"{float(2**40) * buckets * SAMPLE_PER_BUCKET}D * {w}")
    sample = keyed.where(draw).agg(F.expr("sort_array(collect_list(_cl_key))").alias("s"))
    # every m-th sampled key, so that small inputs have few buckets
    step = f"greatest(ceil(size(s) / {buckets}), 1)"
    bounds = sample.select(F.expr(f"filter(s, (k, i) -> i % {step} = {step} - 1 AND i + 1 < size(s))").alias("s"))
    rows = keyed.select("*", *extra) if extra else keyed
    if buckets <= FAN:
        return digits(rows.select("*", bounds.scalar().alias("_cl_bounds")), buckets, _BUCKET).drop("_cl_bounds", "_cl_key")
    size = -(-buckets // FAN)
    placed = chunk_place(rows, bounds.select("s", F.col("s").alias("x")), buckets, size).drop("_cl_chunk", "_cl_bounds", "_cl_key")
    return placed.withColumn(_BUCKET, F.col("_cl_j") * size + F.col("_cl_at")).drop("_cl_j", "_cl_at")


#: Most boundaries that a row carries while its bucket is found.
FAN = 256


def chunk_place(df: DataFrame, index: DataFrame, places: int, size: int) -> DataFrame:
    """Find ``_cl_key`` among many sorted values in two steps: ``index`` has one
    row, the values ``x`` and what belongs to them, ``s`` (arrays of one
    length, at most ``places``).  Chunks of ``size`` are broadcast; a row first
    finds its chunk among the chunks' last values, then its place inside it,
    so it never carries more than a chunk.  Adds ``_cl_j`` (the chunk),
    ``_cl_at`` (the place) and ``_cl_chunk`` (the chunk of ``s``)."""
    lasts = index.select(F.expr(f"filter(x, (k, i) -> i % {size} = {size} - 1 OR i + 1 = size(x))")).scalar()
    number = f"CASE WHEN size(x) > 0 THEN sequence(0, (size(x) - 1) DIV {size}) ELSE CAST(array() AS array<int>) END"
    cut = f"explode(transform({number}, j -> struct(CAST(j AS INT) AS j, slice(x, j * {size} + 1, {size}) AS b, slice(s, j * {size} + 1, {size}) AS c)))"
    chunks = index.select(F.expr(cut).alias("p")).select(F.col("p.j").alias("_cl_j"), F.col("p.b").alias("_cl_bounds"), F.col("p.c").alias("_cl_chunk"))
    found = digits(df.select("*", lasts.alias("_cl_bounds")), -(-places // size) + 1, "_cl_j").drop("_cl_bounds")
    return digits(found.join(F.broadcast(chunks), "_cl_j", "left"), size + 1, "_cl_at")


def digits(df: DataFrame, places: int, out: str) -> DataFrame:
    """Add ``out``: how many of the sorted values in the array ``_cl_bounds``, at
    most ``places - 1`` of them, are smaller than ``_cl_key`` (none of a NULL
    array).  It is found digit by digit, so that no expression grows with the
    array."""
    base, place = max(2, min(16, places)), 1
    while place * base < places:
        place *= base
    low = "0"
    while place:
        df = df.select(*[c for c in df.columns if c != out], F.expr(_digit(low, place, base)).alias(out))
        low, place = out, place // base
    return df


def ordered_index(
    df: DataFrame,
    order: OrderSpec,
    *,
    group: Sequence[str] = (),
    weight: str | None = None,
    before: str = "w_before",
    total: str | None = "w_total",
    slices: int | None = None,
) -> DataFrame:
    """Add ``before`` = summed weight of rows strictly ahead in ``order``
    within the same ``group`` (weight 1 per row when ``weight`` is None), and
    optionally ``total`` = summed weight of the group.

    Rows whose full (group, order) key is equal must not be split apart for
    the result to be meaningful as a rank, so callers either pass unique keys
    or pre-aggregate equal keys into one weighted row.  ``slices`` is the number
    of buckets, by default that of shuffle partitions.
    """
    group = list(group)
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    full = [*[(g, True) for g in group], *[o for o in order if o[0] not in group]]
    # a group of several columns is one struct: as a join key it is never NULL
    ranged = order_bucket(df, full, slices, weight, *([F.struct(*group).alias("_cl_g")] if group else []))
    by = [_BUCKET, "_cl_g"] if group else [_BUCKET]
    w = f"CAST({weight} AS BIGINT)" if weight else "1L"
    # without groups one row per bucket, so at most ``slices`` rows
    over = f"OVER ({'PARTITION BY _cl_g ' if group else ''}ORDER BY {_BUCKET} ROWS BETWEEN UNBOUNDED PRECEDING AND %s)"
    sums = [F.expr(f"coalesce(sum(_cl_pw) {over % '1 PRECEDING'}, 0)").alias("_cl_off")]
    sums += [F.expr(f"sum(_cl_pw) {over % 'UNBOUNDED FOLLOWING'}").alias("_cl_total")] if total else []
    offsets = ranged.groupBy(*by).agg(F.expr(f"sum({w})").alias("_cl_pw")).select(*by, *sums)
    joined = ranged.join(offsets if group else F.broadcast(offsets), by)
    lw = Window.partitionBy(*by).orderBy(*_sort_exprs(order)).rowsBetween(Window.unboundedPreceding, -1)
    placed = (F.col("_cl_off") + F.coalesce(F.sum(F.expr(w)).over(lw), F.lit(0))).cast("bigint").alias(before)
    return joined.select(*df.columns, placed, *([F.col("_cl_total").cast("bigint").alias(total)] if total else []))


def rank_keys(df: DataFrame, order: OrderSpec, *, partition: Sequence[str] = (), out: str = "rnk") -> DataFrame:
    """The rank of every distinct key, from a plain window over the counted
    keys: for order columns of few values."""
    keys = [*partition, *[c for c, _ in order]]
    ahead = Window.partitionBy(*partition).orderBy(*_sort_exprs(order)).rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cl_n"))
    return counts.select(*keys, (F.coalesce(F.sum("_cl_n").over(ahead), F.lit(0)) + 1).cast("bigint").alias(out))


def rank_rows(
    df: DataFrame,
    order: OrderSpec,
    *,
    partition: Sequence[str] = (),
    out: str = "rnk",
    method: str = "scalable",
) -> DataFrame:
    """``RANK() OVER (PARTITION BY partition ORDER BY order)`` as bigint.

    ``scalable``: equal keys are first counted (partial aggregation, so a hot
    value becomes one row), ranks are computed on the distinct keys with
    :func:`ordered_index` and joined back (AQE splits a skewed join key).
    ``counted``: ranks come from a plain window over the counted keys, for
    columns of few values.  ``window``: plain Spark window, for small inputs.
    """
    partition = list(partition)
    if method == "counted":
        return join_null_safe(df, rank_keys(df, order, partition=partition, out=out), [*partition, *[c for c, _ in order]])
    if method == "window":
        w = Window.partitionBy(*partition) if partition else Window.partitionBy()
        return df.withColumn(out, F.rank().over(w.orderBy(*_sort_exprs(order))).cast("bigint"))
    keys = [*partition, *[c for c, _ in order]]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cl_n"))
    idx = ordered_index(counts, order, group=partition, weight="_cl_n", total=None)
    idx = idx.select(*keys, (F.col("w_before") + 1).alias(out))
    return join_null_safe(df, idx, keys)


def cume_dist_rows(
    df: DataFrame,
    order: OrderSpec,
    *,
    partition: Sequence[str] = (),
    out: str = "cume_dist",
    method: str = "scalable",
) -> DataFrame:
    """``CUME_DIST()`` = rows at or ahead of this key (peers included) / rows."""
    partition = list(partition)
    if method == "window":
        w = Window.partitionBy(*partition) if partition else Window.partitionBy()
        return df.withColumn(out, F.cume_dist().over(w.orderBy(*_sort_exprs(order))))
    keys = [*partition, *[c for c, _ in order]]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cl_n"))
    idx = ordered_index(counts, order, group=partition, weight="_cl_n", total="_cl_t")
    idx = idx.select(
        *keys, ((F.col("w_before") + F.col("_cl_n")) / F.col("_cl_t")).cast("double").alias(out)
    )
    return join_null_safe(df, idx, keys)


def row_number_rows(
    df: DataFrame,
    order: OrderSpec,
    *,
    partition: Sequence[str] = (),
    out: str = "row_number",
    total: str | None = None,
    method: str = "scalable",
) -> DataFrame:
    """``ROW_NUMBER()``; ``order`` must be a total order (add a unique
    tie-break column) or the numbering of peers is arbitrary."""
    partition = list(partition)
    if method == "window":
        w = Window.partitionBy(*partition) if partition else Window.partitionBy()
        res = df.withColumn(out, F.row_number().over(w.orderBy(*_sort_exprs(order))).cast("bigint"))
        if total:
            res = res.withColumn(total, F.count(F.lit(1)).over(w).cast("bigint"))
        return res
    idx = ordered_index(df, order, group=partition, total=total)
    return idx.select(*df.columns, (F.col("w_before") + 1).alias(out), *([total] if total else []))


def serial_number(df: DataFrame, order: OrderSpec, out: str = "serial_number") -> DataFrame:
    """Add a 1-based serial number in a declared total order."""
    return row_number_rows(df, order, out=out)


def ntile_rows(
    df: DataFrame,
    n: int,
    order: OrderSpec,
    *,
    partition: Sequence[str] = (),
    out: str = "ntile",
    method: str = "scalable",
) -> DataFrame:
    """``NTILE(n)`` from the row number and the group size.

    With ``q = rows div n`` and ``r = rows mod n`` the first ``r`` tiles hold
    ``q + 1`` rows and the rest ``q`` (Spark and PostgreSQL agree).
    """
    if method == "window":
        w = Window.partitionBy(*partition) if partition else Window.partitionBy()
        return df.withColumn(out, F.ntile(n).over(w.orderBy(*_sort_exprs(order))).cast("bigint"))
    numbered = ordered_index(df, order, group=list(partition), before="_cl_i", total="_cl_cnt")
    i = F.col("_cl_i")
    q = F.floor(F.col("_cl_cnt") / n).cast("bigint")
    r = F.pmod(F.col("_cl_cnt"), F.lit(n))
    big = r * (q + 1)
    tile = F.when(i < big, F.floor(i / (q + 1)) + 1).otherwise(r + F.floor((i - big) / q) + 1)
    return numbered.select(*df.columns, tile.cast("bigint").alias(out))


def nth_highest(df: DataFrame, col: str, n: int, *, out: str | None = None, distinct: bool = False,
                ascending: bool = False) -> DataFrame:
    """Value of the n-th row in ``col`` order (desc by default),
    over the unbounded frame (D19), NULLs last.  One row; NULL when there
    are fewer than n rows.  Runs as a per-partition top-n plus a final merge
    of n rows per partition (TakeOrderedAndProject)."""
    out = out or f"nth_{col}"
    src = df.select(col)
    if distinct:
        src = src.distinct()
    sort = F.col(col).asc_nulls_last() if ascending else F.col(col).desc_nulls_last()
    # the top n of the whole order, then the last of them: n rows a task at most
    return src.orderBy(sort).limit(n).orderBy(sort).offset(n - 1).limit(1).agg(F.max(col).alias(out))


def nth_value_rows(df: DataFrame, col: str, n: int, *, ascending: bool = False, frame: str = "unbounded",
                   out: str | None = None) -> DataFrame:
    """``NTH_VALUE(col, n) OVER (ORDER BY col)`` on every row, NULLs
    last, without moving the rows into one task.

    ``frame='unbounded'``: every row gets the n-th value (the intent).
    ``frame='default'`` (``RANGE UNBOUNDED PRECEDING .. CURRENT ROW``, peers
    included): a row gets it only once its frame, all rows ahead plus its
    peers, holds at least n rows, otherwise NULL.  The frame size comes
    from :func:`ordered_index` on the counted distinct values.
    """
    out = out or f"nth_{col}"
    v_n = nth_highest(df, col, n, out="_cl_vn", ascending=ascending).scalar()
    if frame == "unbounded":
        return df.withColumn(out, v_n)
    if frame != "default":
        raise ValueError("frame must be 'unbounded' or 'default'")
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("_cl_n"))
    idx = ordered_index(counts, [(col, ascending)], weight="_cl_n", total=None)
    idx = idx.select(col, F.when(F.col("w_before") + F.col("_cl_n") >= n, v_n).alias(out))
    return join_null_safe(df, idx, [col])


def top_k_with_ties(df: DataFrame, col: str, k: int, *, ascending: bool = False) -> DataFrame:
    """Rows with ``RANK() OVER (ORDER BY col) <= k``, NULLs excluded.

    rank <= k exactly when the value is at or beyond the value of the k-th
    row, so the operator finds that threshold with a bounded top-k and then
    filters the whole table in parallel; no task collects the tie group.
    """
    base = df.where(F.col(col).isNotNull())
    thr = nth_highest(base, col, k, out="_cl_thr", ascending=ascending)
    thr = thr.select(F.coalesce(F.col("_cl_thr"), F.lit(None).cast(base.schema[col].dataType)).alias("_cl_thr"))
    t = thr.scalar()
    cond = F.col(col) >= t if not ascending else F.col(col) <= t
    # fewer than k rows: every row qualifies
    return base.where(cond | t.isNull())


def stable_sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``ORDER BY random() LIMIT n`` made reproducible: order by a
    pure function of the key, so re-planning or retries draw the same rows."""
    from cohortlens.functions.random import stable_uniform

    return (
        df.withColumn("_cl_u", stable_uniform(key, seed))
        .orderBy(F.col("_cl_u").asc(), F.col(key).asc())
        .limit(n)
        .drop("_cl_u")
    )


def stratified_sample(df: DataFrame, strata: str | Sequence[str], key: str, k: int, seed: int = 0) -> DataFrame:
    """L5/M2 per stratum: the ``k`` rows of each stratum with the smallest draw, a
    pure function of ``key`` and seed (ties by key).  The smallest ``k`` of parts
    are all that the smallest ``k`` of the whole need, so Spark keeps no more
    than that per stratum and task before the shuffle (WindowGroupLimit)."""
    from cohortlens.functions.random import stable_uniform

    strata = [strata] if isinstance(strata, str) else list(strata)
    w = Window.partitionBy(*strata).orderBy(F.col("_cl_u").asc_nulls_last(), F.col(key).asc_nulls_last())
    drawn = df.withColumn("_cl_u", stable_uniform(key, seed))
    return drawn.withColumn("_cl_rn", F.row_number().over(w)).where(F.col("_cl_rn") <= k).drop("_cl_u", "_cl_rn")


def first_value_by(df: DataFrame, group: Sequence[str], value: str, order: OrderSpec,
                   out: str | None = None) -> DataFrame:
    """``FIRST_VALUE(value) OVER (PARTITION BY group ORDER BY order)`` as
    one row per group, NULL order keys last.

    All keys in one direction: ``min_by``/``max_by`` over a struct of
    (NULL flag, key) pairs, an ordinary partial + final aggregate (Spark's
    value ordering puts NaN where a sort does).  Mixed directions:
    ``row_number() = 1`` per group, which Spark plans with a partial
    per-group limit before the shuffle.  Either way a hot group is reduced
    map-side.
    """
    out = out or f"first_{value}"
    if all(asc for _, asc in order):
        parts = [e for i, (c, _) in enumerate(order) for e in (F.col(c).isNull().alias(f"_n{i}"), F.col(c).alias(f"_k{i}"))]
        return df.groupBy(*group).agg(F.min_by(F.col(value), F.struct(*parts)).alias(out))
    if not any(asc for _, asc in order):
        parts = [e for i, (c, _) in enumerate(order)
                 for e in (F.col(c).isNotNull().alias(f"_n{i}"), F.col(c).alias(f"_k{i}"))]
        return df.groupBy(*group).agg(F.max_by(F.col(value), F.struct(*parts)).alias(out))
    w = Window.partitionBy(*group).orderBy(*_sort_exprs(order))
    ranked = df.withColumn("_cl_rn", F.row_number().over(w)).where(F.col("_cl_rn") == 1)
    return ranked.select(*group, F.col(value).alias(out))
