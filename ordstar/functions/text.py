"""Scalar column functions. All are built from ``pyspark.sql.functions`` so they
stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Python's str.strip sees it: every character for which
# str.isspace() holds (derived by rule, not listed).
WHITESPACE = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())
# Plain decimal / scientific number text, optionally signed and padded. Text
# such as "1d" or "1f" (numbers to a Java parser) is rejected on purpose.
NUMBER_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_POS_INF = ("inf", "+inf", "infinity", "+infinity")
_NEG_INF = ("-inf", "-infinity")


def col(name: str) -> Column:
    """Column by its literal name; dotted flat names need backticks."""
    return F.col(f"`{name}`")


def cols(names: Iterable[str]) -> list[Column]:
    return [col(n) for n in names]


def py_strip(c: Column) -> Column:
    """``str.strip()``: removes all leading/trailing whitespace, not only spaces."""
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    """Null, or only whitespace (``strip() == ""``)."""
    return c.isNull() | (py_strip(c) == "")


def null_tokens(c: Column, tokens: Iterable[str]) -> Column:
    """Exact (untrimmed) token match → null, as a text reader's NA list does."""
    return F.when(c.isin(*list(tokens)), F.lit(None).cast("string")).otherwise(c)


def zfill(c: Column, width: int) -> Column:
    """``str.zfill``: left-pad with zeros, never truncate longer text."""
    s = c.cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def capitalize(c: Column) -> Column:
    """``str.capitalize``: first character upper, the rest lower."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def last_number(c: Column, sep: str = "_") -> Column:
    """Integer after the last separator, or null when it is not a number."""
    return F.element_at(F.split(c, sep), -1).try_cast("bigint")


def try_number(c: Column) -> Column:
    """Text → double, null for anything that is not plainly a number.

    Follows a lenient-but-strict numeric reader: surrounding whitespace is
    allowed, thousands separators and type suffixes are not, ``nan`` is null,
    ``inf``/``infinity`` are infinite.
    """
    s = py_strip(c.cast("string"))
    low = F.lower(s)
    return (
        F.when(s.rlike(NUMBER_RE), s.try_cast("double"))
        .when(low.isin(*_POS_INF), F.lit(float("inf")))
        .when(low.isin(*_NEG_INF), F.lit(float("-inf")))
        .otherwise(F.lit(None).cast("double"))
    )
