"""Counts, modes, histograms, bands and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.mathops import width_bin
from cohortlens.operators._util import as_list, check_columns, join_null_safe


def count_by(
    df: DataFrame,
    keys: str | Sequence[str] | None = None,
    *,
    where: Column | None = None,
    distinct: str | None = None,
    having: Column | None = None,
    out: str = "n",
    approx_rsd: float | None = None,
) -> DataFrame:
    """``COUNT(*)`` or ``COUNT(DISTINCT distinct)`` per group (or
    global when ``keys`` is empty), with an optional WHERE and HAVING.

    Exact distinct counts are planned as a two-level aggregate (first by
    group and value, so a hot group is spread by value).  ``approx_rsd``
    switches to HyperLogLog++ (``approx_count_distinct``) with that relative
    standard deviation: one pass, fixed memory per group.
    """
    keys = as_list(keys) if keys else []
    check_columns(df, keys)
    src = df.where(where) if where is not None else df
    if distinct and approx_rsd is not None:
        agg = F.approx_count_distinct(F.col(distinct), approx_rsd)
    else:
        agg = F.count_distinct(F.col(distinct)) if distinct else F.count(F.lit(1))
    res = src.groupBy(*keys).agg(agg.cast("bigint").alias(out))
    return res.where(having) if having is not None else res


def top_group(
    df: DataFrame,
    keys: str | Sequence[str],
    *,
    where: Column | None = None,
    ascending: bool = False,
    k: int = 1,
    out: str = "n",
) -> DataFrame:
    """The k most (or least) frequent groups, ties broken by the keys.

    The limit is the feature (a top-k report).  Counting is a partial +
    final aggregate; the top-k runs as TakeOrderedAndProject.
    """
    keys = as_list(keys)
    counts = count_by(df, keys, where=where, out=out)
    cnt = F.col(out).asc() if ascending else F.col(out).desc()
    return counts.orderBy(cnt, *[F.col(c).asc_nulls_last() for c in keys]).limit(k)


def top_per_group(df: DataFrame, group: str | Sequence[str], item: str, *, k: int = 1,
                  out: str = "n") -> DataFrame:
    """The k most frequent ``item`` values inside each group, ties by
    item.  Ranking runs on the counted (group, item) rows, so a hot group
    contributes one row per distinct item, and Spark inserts a
    WindowGroupLimit before the window's shuffle."""
    group = as_list(group)
    counts = count_by(df, [*group, item], out=out)
    w = Window.partitionBy(*group).orderBy(F.col(out).desc(), F.col(item).asc_nulls_last())
    return counts.withColumn("_cl_rn", F.row_number().over(w)).where(F.col("_cl_rn") <= k).drop("_cl_rn")


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int, *, bucket: str = "bucket",
              out: str = "n") -> DataFrame:
    """Equal-width histogram; bucket 0 is below ``lo``, bins+1 at or
    above ``hi`` (``width_bucket`` semantics), NULL values form their own row."""
    return df.groupBy(width_bin(col, lo, hi, bins).alias(bucket)).agg(F.count(F.lit(1)).cast("bigint").alias(out))


def band(col: str | Column, cuts: Sequence[float], labels: Sequence[str], *, null_label: str | None = "unknown",
         right_closed: bool = True) -> Column:
    """Label by ascending cut points; ``len(labels) == len(cuts)+1``.

    With ``right_closed`` a value equal to a cut falls in the lower band
    (``<= cut``).  NULL gets ``null_label`` (the reference put NULL BMI in
    the lowest band by accident).
    """
    if len(labels) != len(cuts) + 1:
        raise ValueError("need one more label than cut points")
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for cut, label in zip(cuts, labels):
        cond = c <= cut if right_closed else c < cut
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    last = c.isNotNull()
    expr = expr.when(last, F.lit(labels[-1])) if expr is not None else F.when(last, F.lit(labels[-1]))
    if null_label is not None:
        expr = expr.otherwise(F.lit(null_label))
    return expr


def band_by(df: DataFrame, col: str, cuts: Sequence[float], labels: Sequence[str], *,
            null_label: str | None = "unknown", out: str = "band", right_closed: bool = True) -> DataFrame:
    """Add ``out`` with the band label of ``col`` (see :func:`band`)."""
    check_columns(df, [col])
    return df.withColumn(out, band(col, cuts, labels, null_label=null_label, right_closed=right_closed))


def profile(
    df: DataFrame,
    by: str | Sequence[str],
    measure: str,
    *,
    method: str = "exact",
    scale: int | None = 4,
    accuracy: int = 100000,
) -> DataFrame:
    """Per group mean, sample std, Q1, Q3, IQR and mean +- 2 std.

    ``exact``: quartiles by linear interpolation (``percentile_cont``),
    by :func:`exact_quantiles`: a sketch's bracket, then exact selection
    inside, so no raw rows are sorted and a group holding a third of the rows
    is summed map-side.  ``builtin``: Spark's ``percentile``
    (exact, but one task holds a value map per group).  ``approx``:
    ``percentile_approx`` with bounded memory.
    """
    by = as_list(by)
    check_columns(df, [*by, measure])
    m = F.col(measure)
    moments = df.groupBy(*by).agg(
        F.avg(m).alias("mean"), F.stddev_samp(m).alias("std"),
    )
    if method == "exact":
        quarts = exact_quantiles(df, by, measure, {"q1": 0.25, "q3": 0.75})
        res = join_null_safe(moments, quarts, by, "left")
    elif method in ("builtin", "approx"):
        if method == "builtin":
            q1, q3 = F.percentile(m, 0.25), F.percentile(m, 0.75)
        else:
            q1, q3 = F.percentile_approx(m, 0.25, accuracy), F.percentile_approx(m, 0.75, accuracy)
        res = df.groupBy(*by).agg(
            F.avg(m).alias("mean"), F.stddev_samp(m).alias("std"), q1.cast("double").alias("q1"),
            q3.cast("double").alias("q3"),
        )
    else:
        raise ValueError("method must be exact, builtin or approx")
    res = res.withColumns({
        "iqr": F.col("q3") - F.col("q1"),
        "lower_2sd": F.col("mean") - 2 * F.col("std"),
        "upper_2sd": F.col("mean") + 2 * F.col("std"),
    })
    cols = ["mean", "std", "q1", "q3", "iqr", "lower_2sd", "upper_2sd"]
    if scale is not None:
        res = res.withColumns({c: F.round(F.col(c), scale) for c in cols})
    return res.select(*by, *cols)


#: Size of the quantile sketch, half the width of a bracket as a share of the
#: rows (some four times the sketch's 99% error), and the rows from which a
#: group can have brackets.
SKETCH_K, BRACKET, WHOLE_GROUP = 4096, 0.005, 2000


def exact_quantiles(df: DataFrame, by: Sequence[str], measure: str, probs: dict[str, float]) -> DataFrame:
    """``percentile_cont`` for several probabilities, in two passes.

    A mergeable quantile sketch per group gives a bracket around each
    probability.  Brackets of the groups that hold a share worth it, some per
    partition at most, are broadcast; a smaller group is its own bracket.  The
    second pass counts the rows below a bracket and keeps only the counted
    values inside: one row for a value however often it occurs, one row for all
    the rest.  Position ``h = (n - 1) p`` (0-based) is
    then interpolated between the values at ``floor(h)`` and ``ceil(h)``, whose
    exact positions are the rows below plus those of smaller values inside.
    Should a sketch ever miss, the query fails by name rather than answer.
    """
    by = list(by)
    names = list(probs)
    x = F.col(measure).cast("double")
    x = F.when(F.isnan(x), F.lit(float("inf"))).otherwise(x)  # NaN is the largest value
    group = F.struct(*by).alias("_cl_g") if by else F.lit(1).alias("_cl_g")
    rows = df.where(F.col(measure).isNotNull()).select(*by, F.col(measure).alias("_cl_m"), x.alias("_cl_x"), group)
    sketch = rows.groupBy("_cl_g").agg(F.kll_sketch_agg_double("_cl_x", SKETCH_K).alias("k"))

    shares = ", ".join(f"{min(max(s, 0.0), 1.0)}D" for p in probs.values() for s in (p - BRACKET, p + BRACKET))
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = sketch.select("_cl_g", "k", F.expr("kll_sketch_get_n_double(k)").alias("n"))
    large = (F.col("n") > WHOLE_GROUP) & (F.col("n") > held.agg(F.sum("n") / (4 * slices)).scalar())
    brackets = F.broadcast(held.where(large).select("_cl_g", F.expr(f"kll_sketch_get_quantile_double(k, array({shares}))").alias("_cl_q")))
    within = [f"coalesce(_cl_x BETWEEN _cl_q[{2 * i}] AND _cl_q[{2 * i + 1}], TRUE)" for i in range(len(names))]
    inside = [F.expr(e).alias(f"_cl_in{i}") for i, e in enumerate(within)]
    below = [F.expr(f"CAST(count_if(_cl_x < _cl_q[{2 * i}]) AS BIGINT)").alias(f"_cl_below{i}") for i in range(len(names))]
    flagged = rows.join(brackets, "_cl_g", "left").select(*by, "_cl_g", "_cl_x", "_cl_q", F.expr(f"CASE WHEN {' OR '.join(within)} THEN _cl_m END").alias("_cl_m"), *inside)
    counted = flagged.groupBy("_cl_g", *by, "_cl_m", *[f"_cl_in{i}" for i in range(len(names))]).agg(F.count(F.lit(1)).alias("_cl_n"), *below)

    ahead = "OVER (PARTITION BY _cl_g ORDER BY _cl_m NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    at = [f"coalesce(sum(CASE WHEN _cl_in{i} THEN _cl_n END) {ahead}, 0) + sum(_cl_below{i}) OVER (PARTITION BY _cl_g)" for i in range(len(names))]
    placed = counted.select("*", F.expr("sum(_cl_n) OVER (PARTITION BY _cl_g)").alias("_cl_t"), *[F.expr(e).alias(f"_cl_at{i}") for i, e in enumerate(at)])
    aggs = []
    for i, name in enumerate(names):
        h = F.expr(f"(_cl_t - 1) * {probs[name]}D")
        covers = lambda pos, i=i: F.col(f"_cl_in{i}") & F.col("_cl_m").isNotNull() & (F.col(f"_cl_at{i}") <= pos) & (pos < F.col(f"_cl_at{i}") + F.col("_cl_n"))
        x_lo = F.max(F.when(covers(F.floor(h)), F.col("_cl_m")))
        x_hi = F.max(F.when(covers(F.ceil(h)), F.col("_cl_m")))
        missed = F.raise_error(F.lit(f"quantile sketch of {measure} missed {name}: run again")).cast("double")
        value = (x_lo + (x_hi - x_lo) * F.max(h - F.floor(h))).cast("double")
        aggs.append(F.when(x_lo.isNull() | x_hi.isNull(), missed).otherwise(value).alias(name))
    return placed.groupBy("_cl_g", *by).agg(*aggs).drop("_cl_g")
