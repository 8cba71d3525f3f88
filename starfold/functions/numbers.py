"""Numeric columns: decimals, null-safe ratios, sensor rules, bands, text masks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col


def dec(c: Column | str, precision: int, scale: int) -> Column:
    return as_col(c).cast(f"decimal({precision},{scale})")


def money(c: Column | str) -> Column:
    """Amounts are ``decimal(12,2)`` before any arithmetic; never double."""
    return dec(c, 12, 2)


def rounded(c: Column, scale: int, precision: int = 12) -> Column:
    """Round half away from zero, then fix the declared decimal type."""
    return dec(F.round(c, scale), precision, scale)


def safe_ratio(a: Column | str, b: Column | str) -> Column:
    """``a / b``, NULL for a zero or NULL denominator (division by zero raises under ANSI)."""
    return as_col(a) / F.nullif(as_col(b), F.lit(0))


def sentinel_to_null(c: Column | str, sentinel: float) -> Column:
    c = as_col(c)
    return F.when(c != F.lit(sentinel), c)


def negative_to_zero(c: Column | str) -> Column:
    """Clamp below at zero. ``greatest`` would turn NULL into 0, so NULL is kept by hand."""
    c = as_col(c)
    return F.when(c < 0, F.lit(0)).otherwise(c)


def outside_to_null(c: Column | str, low: float, high: float) -> Column:
    c = as_col(c)
    return F.when(c.between(low, high), c)


def ordered_pair(low: Column | str, high: Column | str) -> tuple[Column, Column]:
    """Swap an inverted (low, high) pair; a pair with a NULL is left alone."""
    low, high = as_col(low), as_col(high)
    inverted = low > high
    return F.when(inverted, high).otherwise(low), F.when(inverted, low).otherwise(high)


def band(c: Column | str, limits: Sequence[tuple[float, str]], top: str, missing: str | None = None) -> Column:
    """Label by the first upper limit the value is below; ``top`` past the last one."""
    c = as_col(c)
    label = F.when(c.isNull(), F.lit(missing))
    for limit, name in limits:
        label = label.when(c < limit, F.lit(name))
    return label.otherwise(F.lit(top))


def flag(predicate: Column) -> Column:
    """Boolean flag; an unknown (NULL) predicate is false."""
    return F.coalesce(predicate, F.lit(False))


def number_text(c: Column | str, max_decimals: int, min_decimals: int = 1, symbol: str = ".") -> Column:
    """Plain number text: no grouping, trailing zeros dropped down to ``min_decimals``."""
    text = F.round(dec(c, 38, max_decimals + 2), max_decimals).cast(f"decimal(38,{max_decimals})").cast("string")
    if max_decimals > min_decimals:
        text = F.regexp_replace(text, rf"(\.\d{{{min_decimals}}}\d*?)0+$", "$1")
        if min_decimals == 0:
            text = F.regexp_replace(text, r"\.$", "")
    return text if symbol == "." else F.translate(text, ".", symbol)


def locale_number(c: Column | str, data_type: str, decimal: str = ",", group: str = ".") -> Column:
    """Parse number text with the given decimal and grouping symbols; bad text gives NULL."""
    plain = F.translate(F.trim(as_col(c)), group, "") if group else F.trim(as_col(c))
    return F.translate(plain, decimal, ".").try_cast(data_type)
