"""Surrogate keys that survive a rebuild: a stored registry of natural keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import any_null, skew_join
from ..operators.keys import assign_sk
from ..operators.upsert import absent_rows
from .versions import Load


def stable_keys(load: Load, registry: str, df: DataFrame, keys: Sequence[str], sk: str) -> DataFrame:
    """``df`` with the surrogate key ``sk`` that the ``registry`` table gives its natural ``keys``.

    Keys the registry does not know are numbered after its highest number, in their
    order, and appended to it by this load; a known key never changes its number,
    whatever is loaded later or rebuilt. Rows with a NULL in the natural key get no number.
    """
    highest = load.note(registry).get("highest", 0)
    natural = df.select(*keys).where(~any_null(keys)).distinct()
    fresh = absent_rows(load.read(registry), natural, keys) if registry in load else natural
    added = load.append(registry, assign_sk(fresh, sk, list(keys), start=highest + 1).select(*keys, sk))
    load.set_note(registry, {"highest": highest + added.count()})
    numbered = load.read(registry).select(*keys, F.col(sk))
    return skew_join(df, numbered, list(keys), "left")
