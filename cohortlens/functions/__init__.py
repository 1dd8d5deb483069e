"""Column expressions (all JVM built-ins; no Python UDFs)."""

from cohortlens.functions.dates import age_as_of, day_of_week0, days_between, month_start, span_days
from cohortlens.functions.mathops import gcd, lcm, parity, quotient, remainder_capped, safe_ratio, width_bin
from cohortlens.functions.random import stable_uniform
from cohortlens.functions.text import (
    bit_count,
    char_count,
    escape_like,
    is_palindrome,
    join_text,
    text_bar,
    word,
)

__all__ = [
    "age_as_of",
    "bit_count",
    "char_count",
    "day_of_week0",
    "days_between",
    "escape_like",
    "gcd",
    "is_palindrome",
    "join_text",
    "lcm",
    "month_start",
    "parity",
    "quotient",
    "remainder_capped",
    "safe_ratio",
    "span_days",
    "stable_uniform",
    "text_bar",
    "width_bin",
    "word",
]
