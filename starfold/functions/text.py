"""Text columns: codes, trimming, value maps, vocabularies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zero_pad(c: Column | str, width: int) -> Column:
    """Left-pad with zeros to at least ``width``; a longer text stays whole, so codes of distinct numbers stay distinct."""
    text = as_col(c).cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def fixed_pad(c: Column | str, width: int) -> Column:
    """SQL ``LPAD``: exactly ``width`` characters, a longer text is cut. Not for identifiers."""
    return F.lpad(as_col(c).cast("string"), width, "0")


def trim_all(c: Column | str) -> Column:
    """Strip every kind of white space from both ends, not just blanks."""
    return F.regexp_replace(as_col(c), r"^\s+|\s+$", "")


def title_case(c: Column | str) -> Column:
    """Trim and capitalise each blank-separated word."""
    return F.initcap(F.trim(as_col(c)))


def cycle(values: Sequence, n: Column) -> Column:
    """``values[n mod len]``: the round-robin pick of generated attributes."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (n % len(values) + 1).cast("int"))


def map_values(c: Column | str, mapping: Mapping, default: Column | None = None) -> Column:
    """Exact replacement. Unmapped values stay unless ``default`` is given; NULL stays NULL."""
    c = as_col(c)
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    mapped = F.try_element_at(F.create_map(*pairs), c)
    if default is None:
        return F.coalesce(mapped, c)
    return F.when(c.isNotNull(), F.coalesce(mapped, default))


def canonical(c: Column | str, spellings: Mapping[str, Sequence[str]]) -> Column:
    """Replace known spellings, compared trimmed and lower-cased, by their canonical form.

    Unknown values are returned untouched, including their blanks.
    """
    c = as_col(c)
    to_canonical = {variant: name for name, variants in spellings.items() for variant in variants}
    pairs = [F.lit(x) for pair in to_canonical.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(trim_all(c))), c)


def in_vocabulary(c: Column | str, allowed: Sequence[str], default: str) -> Column:
    """Keep a value (as it is, untrimmed) whose trimmed form is allowed, else ``default``."""
    c = as_col(c)
    return F.when(trim_all(c).isin(*allowed), c).otherwise(F.lit(default))
