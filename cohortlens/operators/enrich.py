"""Column enrichment as pure transforms.

The reference altered tables in place; here every change returns a new
DataFrame, optionally written as a new snapshot (sources.write_snapshot).
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.random import stable_uniform
from cohortlens.operators._util import as_list


def parse_band(label: str) -> tuple[int, int]:
    """'21-29' -> (21, 29): inclusive bounds read from the label itself."""
    m = re.fullmatch(r"\s*(-?\d+)\s*-\s*(-?\d+)\s*", label)
    if not m:
        raise ValueError(f"band label {label!r} is not 'lo-hi'")
    return int(m.group(1)), int(m.group(2))


def band_value(
    df: DataFrame,
    band_col: str,
    key: str,
    *,
    bands: Mapping[str, tuple[int, int]] | None = None,
    seed: int = 0,
    out: str = "value",
) -> DataFrame:
    """A whole number inside each row's band, ``lo + floor(u *
    (hi - lo + 1))`` with ``u`` a stable uniform of the key (D20), so the
    value never leaves the band and does not change on retries.  Bands
    come from ``bands`` or are parsed from 'lo-hi' labels."""
    u = stable_uniform(key, seed)
    if bands is None:
        # same rule as parse_band: 'lo-hi' with optional signs, e.g. '-5-5'
        pat = r"^\s*(-?\d+)\s*-\s*(-?\d+)\s*$"
        lo = F.nullif(F.regexp_extract(F.col(band_col), pat, 1), F.lit("")).cast("bigint")
        hi = F.nullif(F.regexp_extract(F.col(band_col), pat, 2), F.lit("")).cast("bigint")
    else:
        lo_e = hi_e = None
        for label, (a, b) in bands.items():
            cond = F.col(band_col) == label
            lo_e = F.when(cond, F.lit(a)) if lo_e is None else lo_e.when(cond, F.lit(a))
            hi_e = F.when(cond, F.lit(b)) if hi_e is None else hi_e.when(cond, F.lit(b))
        lo, hi = lo_e.cast("bigint"), hi_e.cast("bigint")
    return df.withColumn(out, (lo + F.floor(u * (hi - lo + 1))).cast("bigint"))


def code_labels(df: DataFrame, col: str, mapping: Mapping, *, out: str | None = None, default: str | None = None) -> DataFrame:
    """Label a code through a literal mapping (a CASE chain, compiled
    into the stage; unknown codes get ``default``)."""
    expr = None
    for code, label in mapping.items():
        cond = F.col(col) == F.lit(code)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if default is not None:
        expr = expr.otherwise(F.lit(default))
    return df.withColumn(out or f"{col}_label", expr)


def add_if_missing(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column only when the schema lacks it."""
    if name.lower() in {c.lower() for c in df.columns}:
        return df
    return df.withColumn(name, value)


def drop_if_present(df: DataFrame, name: str) -> DataFrame:
    """Drop a column when present (a no-op otherwise)."""
    return df.drop(name)


def apply_update(df: DataFrame, updates: Mapping[str, Column], where: Column | None = None) -> DataFrame:
    """``UPDATE t SET c = expr [WHERE ...] RETURNING *`` as a transform
    returning every row."""
    if where is None:
        return df.withColumns(dict(updates))
    return df.withColumns({c: F.when(where, e).otherwise(F.col(c)) for c, e in updates.items()})


def update_from(df: DataFrame, source: DataFrame, key: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``UPDATE df SET c = s.c FROM source s WHERE key matches``:
    left join, keep the old value where the source has no row.  ``source``
    must hold one row per key (aggregate first)."""
    key = as_list(key)
    src = source.select(*key, *[F.col(c).alias(f"_cl_new_{c}") for c in columns], F.lit(True).alias("_cl_hit"))
    joined = df.join(src, on=key, how="left")
    # a matched source row sets the value even when it is NULL
    return joined.withColumns(
        {c: F.when(F.col("_cl_hit"), F.col(f"_cl_new_{c}")).otherwise(F.col(c)) for c in columns}
    ).drop(*[f"_cl_new_{c}" for c in columns], "_cl_hit")


def first_event_year(entities: DataFrame, events: DataFrame, key: str, event_key: str, ts: str, *,
                     out: str = "first_year") -> DataFrame:
    """Q2: year of each entity's earliest event (not an arbitrary one), as a
    left join of the per-entity minimum."""
    first = events.groupBy(F.col(event_key).alias(key)).agg(F.year(F.min(ts)).cast("bigint").alias(out))
    return entities.join(first, on=key, how="left")


def stack_child(parent: DataFrame, child: DataFrame) -> DataFrame:
    """A parent scan that includes its child's rows (table
    inheritance): union by name, columns missing on one side become NULL."""
    return parent.unionByName(child, allowMissingColumns=True)
