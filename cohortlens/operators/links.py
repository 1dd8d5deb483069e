"""Linked records, extremes and cumulative-range lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def extreme_rows(df: DataFrame, col: str, how: str = "max") -> DataFrame:
    """Every row whose ``col`` equals the column's max (or min),
    ties included.  The extreme is an uncorrelated scalar subquery, so the
    table is filtered in parallel against one value."""
    agg = F.max(col) if how == "max" else F.min(col)
    return df.where(F.col(col) == df.agg(agg).scalar())


def linked_rows(
    items: DataFrame,
    entity: str,
    item: str,
    match: Column | None = None,
    *,
    seeds: DataFrame | None = None,
    hops: int = 1,
) -> DataFrame:
    """All rows of entities linked to a matching item.

    The first entities are those of rows that satisfy ``match``, or the column
    ``entity`` of ``seeds`` where the caller finds them at less cost.
    hops=1: the rows of these entities (a semi-join, the intent of the
    reference's recursion, which only re-joined the same key).  hops>1 follows
    entity -> item -> entity links, the entity set distinct after every round.
    Nothing runs before the result is asked for.
    """
    frontier = (seeds if seeds is not None else items.where(match)).select(entity).distinct()
    for _ in range(hops - 1):
        linked_items = items.join(frontier, on=entity, how="left_semi").select(item).distinct()
        frontier = items.join(linked_items, on=item, how="left_semi").select(entity).union(frontier).distinct()
    return items.join(frontier, on=entity, how="left_semi")


def linked_closure(items: DataFrame, entity: str, item: str, seeds: DataFrame, *, out: str = "hop") -> DataFrame:
    """Every entity that links of shared items lead to from ``seeds``,
    with the round that first reached it (seeds: 0), until a round finds none.

    A round joins only what the round before found: the items of its new
    entities that no earlier round had, then the entities of these.  Rounds are
    written tables, so lineage stays short and a lost executor repeats no
    round.  NULL entities and items link nothing.
    """
    from cohortlens.sources.scratch import written

    both = F.col(entity).isNotNull() & F.col(item).isNotNull()
    links = written(items.select(entity, item).where(both).distinct(), "links")
    found = written(seeds.select(entity).where(F.col(entity).isNotNull()).distinct().withColumn(out, F.lit(0).cast("bigint")), "found")
    rounds, used = [found], []
    while not rounds[-1].isEmpty():
        new_items = links.join(rounds[-1], entity, "left_semi").select(item).distinct()
        for old in used:
            new_items = new_items.join(old, item, "left_anti")
        used.append(written(new_items, "items"))
        reached = links.join(used[-1], item, "left_semi").select(entity).distinct()
        # an entity of a new item was first found in this round or the last, or is new
        for old in rounds[-2:]:
            reached = reached.join(old, entity, "left_anti")
        rounds.append(written(reached.withColumn(out, F.lit(len(rounds)).cast("bigint")), "found"))
        used = used[-2:]
    closed = rounds[0]
    for r in rounds[1:]:
        closed = closed.unionByName(r)
    return closed


def range_lookup(
    df: DataFrame,
    value: str,
    bounds: DataFrame,
    bound_col: str,
    label_col: str,
    *,
    out: str = "slice",
    method: str = "index",
    max_bounds: int = 1_000_000,
    slices: int | None = None,
) -> DataFrame:
    """For each row, the label of the first bound (in ascending bound
    order) that is >= ``value``; NULL when every bound is smaller.  Equal bounds
    give the smallest label.

    Values and bounds are compared in the type that a union of both columns has
    (Spark's common type).  ``index``: the bounds are sorted once and broadcast in
    chunks; a row finds its chunk, then its place in it, digit by digit with
    plain column expressions, so ``df`` is read once, without a shuffle, and a
    hot value costs nothing.  As all bounds are held at once, it fails by name
    on more than ``max_bounds``.  ``merge``: for any number of bounds, see :func:`_merged_lookup`.
    """
    common = df.select(F.col(value).alias("_cl_x")).union(bounds.select(bound_col)).schema["_cl_x"].dataType
    given = bounds.select(F.col(bound_col).cast(common).alias("x"), F.col(label_col).alias("l")).where("x IS NOT NULL")
    if method == "merge":
        return _merged_lookup(df, value, given, common, out, slices)
    if method != "index":
        raise ValueError("method must be index or merge")
    from cohortlens.operators.ranking import chunk_place

    every = given.limit(max_bounds + 1).agg(F.expr("sort_array(collect_list(struct(x, l)))").alias("s"))
    too_many = f"raise_error('more than {max_bounds} bounds: use method=merge')"
    index = every.select(F.expr(f"CASE WHEN size(s) > {max_bounds} THEN {too_many} ELSE s END").alias("s")).select("s", F.expr("s.x").alias("x"))
    rows = df.select("*", F.col(value).cast(common).alias("_cl_key"))
    placed = chunk_place(rows, index, max_bounds, max(1, int(max_bounds**0.5)))
    label = F.when(F.col("_cl_key").isNotNull(), F.get("_cl_chunk", F.col("_cl_at"))["l"])
    return placed.select(*df.columns, label.alias(out))


def _merged_lookup(df: DataFrame, value: str, bounds: DataFrame, common, out: str, slices: int | None) -> DataFrame:
    """:func:`range_lookup` for any number of ``bounds (x, l)``: distinct values
    (tag 0) and bounds (tag 1) are merged into one order by (x, tag), so a
    bound equal to a value comes right after it, and cut into buckets of that
    order; a value takes the first bound at or after it in its bucket, or else
    the first of the later buckets, from a table with a row per bucket.  The
    answer per distinct value is joined back on the value, an equi-join that
    AQE can split when skewed."""
    from cohortlens.operators.ranking import _BUCKET, order_bucket

    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    label_type = bounds.schema["l"].dataType
    vals = df.select(F.col(value).cast(common).alias("_cl_x")).where(F.col("_cl_x").isNotNull()).distinct().select(
        "_cl_x", F.lit(0).alias("_cl_tag"), F.lit(None).cast(label_type).alias("_cl_l"))
    bnd = bounds.select(F.col("x").alias("_cl_x"), F.lit(1).alias("_cl_tag"), F.col("l").alias("_cl_l"))
    merged = order_bucket(vals.unionByName(bnd), [("_cl_x", True), ("_cl_tag", True)], slices)
    w = Window.partitionBy(_BUCKET).orderBy("_cl_x", "_cl_tag", F.col("_cl_l").asc_nulls_first()).rowsBetween(
        0, Window.unboundedFollowing)
    local = merged.withColumn("_cl_next", F.first(F.when(F.col("_cl_tag") == 1, F.struct("_cl_x", "_cl_l")),
                                                  ignorenulls=True).over(w))
    # first bound of every bucket, then for each bucket that of the nearest
    # later one that has any (at most ``slices`` rows)
    heads = merged.groupBy(_BUCKET).agg(F.min(F.when(F.col("_cl_tag") == 1, F.struct("_cl_x", "_cl_l"))).alias("_cl_head"))
    after = Window.orderBy(_BUCKET).rowsBetween(1, Window.unboundedFollowing)
    carry = heads.select(_BUCKET, F.first("_cl_head", ignorenulls=True).over(after).alias("_cl_carry"))
    res = local.where(F.col("_cl_tag") == 0).join(F.broadcast(carry), _BUCKET, "left")
    answer = res.select("_cl_x", F.coalesce(F.col("_cl_next")["_cl_l"], F.col("_cl_carry")["_cl_l"]).alias(out))
    return df.join(answer, F.col(value).cast(common) == F.col("_cl_x"), "left").drop("_cl_x")


def cumulative_bounds(df: DataFrame, label: str, *, out_bound: str = "upper", out_label: str | None = None) -> DataFrame:
    """Shares per label as cumulative upper bounds in (0, 1], label order (NULL
    last): running sums over one counted row per label."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_cl_n"))
    upto = F.sum("_cl_n").over(Window.orderBy(F.col(label).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("_cl_n").over(Window.partitionBy())
    return counts.select(F.col(label).alias(out_label or label), (upto / total).cast("double").alias(out_bound))
