"""Per-entity nested values: arrays of records, JSON, joined text
(A28-A31, R1-R3, X4, J15).

A per-entity array is one value, and one entity may own a third of all
rows.  So every entity, whatever its size, is cut by one rule: a record's part
is its position in ``order_by`` order divided by ``per_part``, a fixed part of
the output.  The parts in order, joined, are the entity's ordered value.

Entities are counted first.  The records of one that holds no more than a
partition's fair share of all are shuffled once, to where the entity is,
numbered in order there and gathered into parts without moving again.  The few
heavier ones (fewer than partitions, so their keys are broadcast) get their
positions from
:func:`cohortlens.operators.ranking.ordered_index`: an entity is split into
runs, each numbered by a task of its own, and a run's offset is the count of
the runs before it; equal records are counted first and cover a stretch of
positions, so many equal rows are one row on the way.  NULL is an entity like
any other.  No record is dropped, and nothing runs before the result is asked
for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.operators._util import as_list
from cohortlens.operators.ranking import ordered_index

DEFAULT_PER_PART = 50_000

# whole-value JSON: keep NULL fields and full timestamp precision
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def collect_sorted(
    df: DataFrame,
    key: str | Sequence[str],
    fields: Sequence[str],
    order_by: Sequence[str],
    *,
    out: str = "records",
    per_part: int = DEFAULT_PER_PART,
) -> DataFrame:
    """``(key..., part, n, records)`` with ``records`` an array of
    structs of ``fields`` sorted by ``order_by`` (then by the fields, NULLs
    last), ``per_part`` records a part."""
    key = as_list(key)
    order_by = list(order_by)
    sort_fields = order_by + [f for f in fields if f not in order_by]
    own = [f for f in sort_fields if f not in key]
    rows = df.select(*key, *own, F.struct(*key).alias("_cl_g"))  # as a join key, a struct is never NULL
    counts = rows.groupBy("_cl_g").count()
    share = counts.agg(F.sum("count") / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))).scalar()
    heavy = F.broadcast(counts.where(F.col("count") > share).select("_cl_g"))
    light = _light_parts(rows.join(heavy, "_cl_g", "left_anti"), key, fields, sort_fields, out, per_part)
    return light.unionByName(_heavy_parts(rows.join(heavy, "_cl_g", "left_semi"), key, fields, sort_fields, own, out, per_part))


def _light_parts(rows: DataFrame, key: list[str], fields: Sequence[str], sort_fields: list[str], out: str, per_part: int) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*[F.col(c).asc_nulls_last() for c in sort_fields])
    at = rows.select(*key, F.struct(*fields).alias("_cl_rec"), (F.row_number().over(w) - 1).alias("_cl_at"))
    part = F.floor(F.col("_cl_at") / per_part).alias("part")
    agg = at.groupBy(*key, part).agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(F.struct("_cl_at", "_cl_rec"))).alias("_cl_arr"))
    return agg.select(*key, "part", "n", F.col("_cl_arr._cl_rec").alias(out))


def _heavy_parts(rows: DataFrame, key: list[str], fields: Sequence[str], sort_fields: list[str], own: list[str], out: str, per_part: int) -> DataFrame:
    counted = rows.groupBy(*key, *own).agg(F.count(F.lit(1)).alias("_cl_times"))
    placed = ordered_index(counted, [(c, True) for c in sort_fields], group=key, weight="_cl_times", before="_cl_at", total=None)
    until = F.col("_cl_at") + F.col("_cl_times")
    parts = F.sequence(F.floor(F.col("_cl_at") / per_part), F.floor((until - 1) / per_part))
    spread = placed.withColumn("part", F.explode(parts))
    inside = F.least(until, (F.col("part") + 1) * per_part) - F.greatest(F.col("_cl_at"), F.col("part") * per_part)
    rec = F.struct(F.col("_cl_at"), inside.cast("int").alias("_cl_times"), F.struct(*[F.col(f) for f in fields]).alias("_cl_rec"))
    # positions differ, so the records themselves are never compared
    agg = spread.groupBy(*key, "part").agg(F.sum(inside).cast("bigint").alias("n"), F.sort_array(F.collect_list(rec)).alias("_cl_arr"))
    repeated = F.flatten(F.transform("_cl_arr", lambda r: F.array_repeat(r["_cl_rec"], r["_cl_times"])))
    return agg.select(*key, "part", "n", repeated.alias(out))


def records_per_entity(df: DataFrame, key, fields, order_by, *, per_part: int = DEFAULT_PER_PART) -> DataFrame:
    """Sorted array of records per entity, plus its JSON text."""
    res = collect_sorted(df, key, fields, order_by, per_part=per_part)
    return res.withColumn("records_json", F.to_json("records", JSON_OPTIONS))


def json_per_entity(df: DataFrame, key: str | Sequence[str], order_by: Sequence[str], *,
                    per_part: int = DEFAULT_PER_PART, out: str = "rows_json") -> DataFrame:
    """``json_agg(whole row)`` per entity; NULL fields are kept
    (D17), timestamps keep their microseconds (Spark's default JSON format
    would cut them to milliseconds), rows sorted by ``order_by``."""
    res = collect_sorted(df, key, list(df.columns), order_by, out="_cl_rows", per_part=per_part)
    return res.withColumn(out, F.to_json("_cl_rows", JSON_OPTIONS)).drop("_cl_rows")


def joined_text(
    df: DataFrame,
    key: str | Sequence[str],
    value: Column | str,
    order_by: Sequence[str],
    *,
    sep: str = ",",
    out: str = "text",
    per_part: int = DEFAULT_PER_PART,
) -> DataFrame:
    """``string_agg(value, sep ORDER BY order_by)`` per entity."""
    v = F.col(value) if isinstance(value, str) else value
    src = df.withColumn("_cl_v", v.cast("string"))
    res = collect_sorted(src, key, ["_cl_v"], list(order_by), out="_cl_recs", per_part=per_part)
    return res.withColumn(out, F.array_join(F.transform("_cl_recs", lambda r: r["_cl_v"]), sep)).drop("_cl_recs")


def entity_digest(
    frames: Sequence[DataFrame],
    key: str,
    template: Sequence[str],
    order_by: Sequence[str],
    *,
    sep: str = ";",
    field_sep: str = ",",
    out: str = "digest",
    per_part: int = DEFAULT_PER_PART,
) -> DataFrame:
    """One text per entity for *all* entities (filter afterwards):
    the frames are joined on ``key`` (J2, key kept once) and each joined row
    is rendered as ``template`` fields joined by ``field_sep`` (NULL as ''),
    then rows are joined by ``sep`` in ``order_by`` order."""
    joined = frames[0]
    for f in frames[1:]:
        joined = joined.join(f, on=key, how="inner")
    row_text = F.concat_ws(field_sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in template])
    return joined_text(joined, key, row_text, order_by, sep=sep, out=out, per_part=per_part)
