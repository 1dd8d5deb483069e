"""Stable pseudo-random numbers derived from a key.

``rand(seed)`` depends on partitioning, so a retried or re-planned task
would draw different numbers.  These values are a pure function of the key
and the seed: the leading 52 bits of ``md5(seed:key)``, a hash that any SQL
engine has, so neighbouring keys and seeds draw unrelated numbers.  Keys of
any type that casts to text work; a NULL key draws NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 13 hexadecimal digits are the 52 bits that a double holds.
DIGITS = 13
RANGE = 2**52


def stable_uniform(key: Column | str, seed: int = 0) -> Column:
    """A double in [0, 1) fixed by ``(key, seed)``."""
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("bigint") / F.lit(float(RANGE))


def stable_uniform_sql(key_sql: str, seed: int = 0) -> str:
    """The same value as SQL text (used by the DuckDB oracle)."""
    return f"(CAST(('0x' || substr(md5('{seed}:' || CAST({key_sql} AS VARCHAR)), 1, {DIGITS})) AS BIGINT) / {float(RANGE)})"
