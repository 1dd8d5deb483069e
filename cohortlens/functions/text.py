"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _c(x: ColumnLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def escape_like(text: str, escape: str = "\\") -> str:
    """Escape ``%`` and ``_`` in user input before it is used in LIKE."""
    return text.replace(escape, escape * 2).replace("%", escape + "%").replace("_", escape + "_")


def word(col: ColumnLike, n: int, sep: str = " ") -> Column:
    """N-th word (1-based); NULL instead of '' past the end."""
    return F.nullif(F.split_part(_c(col), F.lit(sep), F.lit(n)), F.lit(""))


def char_count(col: ColumnLike) -> Column:
    """Characters (code points), as bigint."""
    return F.char_length(_c(col)).cast("bigint")


def bit_count(col: ColumnLike) -> Column:
    """Bits of the UTF-8 encoding (correct for multibyte text)."""
    return F.bit_length(_c(col)).cast("bigint")


def is_palindrome(col: ColumnLike, ignore_case: bool = False) -> Column:
    """``s = reverse(s)``."""
    c = F.lower(_c(col)) if ignore_case else _c(col)
    return c == F.reverse(c)


def join_text(cols: list[ColumnLike], sep: str, null_text: str = "") -> Column:
    """T1 with D5: NULL parts become ``null_text`` and keep their separator."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(null_text)) for c in cols]
    return F.concat_ws(sep, *parts)


def text_bar(count: ColumnLike, largest: ColumnLike, width: int = 40, symbol: str = "*") -> Column:
    """A bar of at most ``width`` symbols, in proportion to the ``largest``
    count, so that its length does not grow with the data."""
    return F.repeat(F.lit(symbol), F.floor(_c(count) * width / _c(largest)).cast("int"))
