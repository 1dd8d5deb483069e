"""Text filters and features as DataFrame operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.text import bit_count, char_count, escape_like, is_palindrome
from cohortlens.operators._util import check_columns


def matching(
    df: DataFrame,
    col: str,
    *,
    like: str | None = None,
    ilike: str | None = None,
    regex: str | None = None,
    prefix: str | None = None,
    longer_than: int | None = None,
) -> DataFrame:
    """Rows whose ``col`` matches every given condition: a LIKE pattern
    (case-sensitive), an ILIKE pattern, a regular expression (``(?i)`` for
    case-insensitive), a literal prefix (user input: ``%`` and ``_`` are
    escaped; matched case-insensitively), or a minimum length."""
    check_columns(df, [col])
    c = F.col(col)
    cond = F.lit(True)
    if like is not None:
        cond = cond & c.like(like)
    if ilike is not None:
        cond = cond & c.ilike(ilike)
    if regex is not None:
        cond = cond & c.rlike(regex)
    if prefix is not None:
        cond = cond & c.ilike(escape_like(prefix) + "%")
    if longer_than is not None:
        cond = cond & (F.char_length(c) > longer_than)
    return df.where(cond)


def text_features(df: DataFrame, col: str, *, prefix: str | None = None) -> DataFrame:
    """Add characters, UTF-8 bits, the reversed text and a palindrome flag
    of ``col`` (T6-T9)."""
    check_columns(df, [col])
    p = prefix if prefix is not None else f"{col}_"
    return df.withColumns({
        f"{p}chars": char_count(col),
        f"{p}bits": bit_count(col),
        f"{p}reversed": F.reverse(F.col(col)),
        f"{p}is_palindrome": is_palindrome(col),
    })
