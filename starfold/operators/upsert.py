"""Merge family: upsert with per-column flags, insert-if-absent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .dedup import top1_per_group
from .joins import any_null, is_small, row_hash, skew_join
from .keys import assign_sk

_SPREAD = "_spread"


def _keyed(df: DataFrame, keys: Sequence[str], tag: str) -> DataFrame:
    """Move all columns but the keys into one struct ``tag``; NULL keys get a spreading value."""
    rest = [c for c in df.columns if c not in keys]
    return df.select(
        *keys,
        # NULL keys match nothing; the row hash keeps them from meeting in one partition.
        F.when(any_null(keys), row_hash(df)).otherwise(F.lit(0)).alias(_SPREAD),
        F.struct(F.lit(True).alias("_here"), *rest).alias(tag),
    )


def _paired(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, t, s): every target row with its source row, and the source rows without a target.

    A source small enough to broadcast meets the target without moving it: the
    target is read twice, the second time its keys only. Otherwise both sides are
    shuffled once by key.
    """
    t, s = _keyed(target, keys, "t"), _keyed(source, keys, "s")
    if not is_small(source):
        return t.join(s, [*keys, _SPREAD], "full_outer")
    t, s = t.drop(_SPREAD), s.drop(_SPREAD)
    matched = t.select(*keys).join(s.select(*keys), keys, "left_semi")
    inserted = s.join(matched, keys, "left_anti").withColumn("t", F.lit(None).cast(t.schema["t"].dataType))
    return t.join(s, keys, "left").select(*keys, "t", "s").unionByName(inserted.select(*keys, "t", "s"))


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row per key in ``order``. Rows with a NULL key never merge, so all of them stay."""
    keyed = top1_per_group(df.filter(~any_null(keys)), keys, order)
    return keyed.unionByName(df.filter(any_null(keys)))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    insert_only_cols: Sequence[str] = (),
    order_by: Sequence[Column | str] | None = None,
    sk: str | None = None,
) -> DataFrame:
    """Merged table: matched rows take the source's ``update_cols``, absent ones are inserted.

    ``insert_only_cols`` are filled on insert and never changed after; further
    target columns keep their value and are NULL on insert. When a key occurs
    several times in ``source`` the last row in ``order_by`` wins; without
    ``order_by`` the caller vouches for unique keys. A NULL key matches nothing
    and is always inserted. ``sk`` names a surrogate column: existing values
    survive, new rows continue after the highest one in key order.

    The result is a new DataFrame; write it to a new version, never over the
    files being read.
    """
    keys = list(keys)
    if update_cols is None:
        update_cols = [c for c in source.columns if c not in keys and c not in insert_only_cols and c in target.columns]
    update_cols, insert_only_cols = list(update_cols), list(insert_only_cols)
    carried = [c for c in [*keys, *update_cols, *insert_only_cols] if c in source.columns]
    if order_by is not None:
        source = one_per_key(source, keys, [F.col(o).desc() if isinstance(o, str) else o.desc() for o in order_by])
    source = source.select(*dict.fromkeys(carried))
    both = _paired(target, source, keys)
    was, now = F.col("t._here").isNotNull(), F.col("s._here").isNotNull()

    def merged(name: str) -> Column:
        if name in keys:
            return F.col(name)
        if name in update_cols:
            return F.when(now, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}"))
        if name in insert_only_cols:
            return F.when(was, F.col(f"t.{name}")).otherwise(F.col(f"s.{name}"))
        return F.col(f"t.{name}")

    result = both.select(*[merged(c).cast(target.schema[c].dataType).alias(c) for c in target.columns])
    return result if sk is None else number_new_rows(result, sk, keys)


def number_new_rows(merged: DataFrame, sk: str, order: Sequence[str]) -> DataFrame:
    """Give rows whose ``sk`` is NULL the numbers after the highest one in use."""
    merged = written(merged, "merged")
    highest = merged.agg(F.max(sk)).first()[0] or 0
    known = merged.filter(F.col(sk).isNotNull())
    fresh = merged.filter(F.col(sk).isNull()).drop(sk)
    return known.unionByName(assign_sk(fresh, sk, order, start=highest + 1).select(*merged.columns))


def absent_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] | None = None
) -> DataFrame:
    """Source rows whose key the target lacks; the first one in ``order_by`` per key."""
    if order_by is not None:
        source = one_per_key(source, keys, order_by)
    return skew_join(source, target.select(*keys), list(keys), "left_anti").select(*source.columns)


def insert_if_absent(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] | None = None
) -> DataFrame:
    """Target plus the source rows with new keys; existing rows never change."""
    return target.unionByName(absent_rows(target, source, keys, order_by).select(*target.columns))
