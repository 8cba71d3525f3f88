"""Lookups with defaults, orphan detection, surrogate-key resolution and re-keying."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import top1_per_group
from .joins import distinct_rows, sized_join, skew_join, skewed


def lookup(
    df: DataFrame,
    ref: DataFrame,
    keys: Mapping[str, str],
    values: Mapping[str, tuple[str, object]],
    first_by: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Left lookup: every row of ``df`` is kept, a missing match gives the default, a matched NULL stays NULL.

    ``keys`` maps columns of ``df`` to columns of ``ref``; ``values`` maps columns
    of ``ref`` to (output name, default). With ``first_by`` several matches are
    reduced to the first one; without it ``ref`` must be unique on its keys.
    """
    if first_by is not None:
        ref = top1_per_group(ref, list(keys.values()), first_by)
    # Every output is aliased, so a value that is itself a lookup key stays apart from it.
    side = ref.select(
        *[F.col(r).alias(d) for d, r in keys.items()],
        *[F.col(r).alias(f"_v_{name}") for r, (name, _) in values.items()],
        F.lit(True).alias("_found"),
    )
    joined = skew_join(df, side, list(keys), "left")
    kept = [c for c in df.columns if c not in {name for name, _ in values.values()}]
    return joined.select(
        *kept,
        *[F.when(F.col("_found"), F.col(f"_v_{name}")).otherwise(F.lit(default)).alias(name) for name, default in values.values()],
    )


def orphans(df: DataFrame, ref: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Rows of ``df`` without a partner in ``ref``; a NULL key has none."""
    side = distinct_rows(ref.select(*[F.col(r).alias(d) for d, r in keys.items()]))  # a hot key of ``ref`` combines before the shuffle
    return skew_join(df, side, list(keys), "left_anti").select(*df.columns)


def resolve_keys(source: DataFrame, dims: Mapping[str, tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """Replace natural keys by surrogate keys, one inner join per dimension.

    ``dims`` maps the surrogate column to (dimension, {source column: dimension
    column}). Rows without a match drop out; :func:`unresolved` lists them.
    """
    sides = {sk: dim.select(sk, *[F.col(d).alias(s) for s, d in keys.items()]) for sk, (dim, keys) in dims.items()}
    # Found before the first join, so that no join is computed again to count keys.
    hot = {sk: skewed(source, sides[sk], list(keys)) for sk, (_, keys) in dims.items()}
    for sk, (_, keys) in dims.items():
        source = skew_join(source, sides[sk], list(keys), hot=hot[sk])
    return source


def unresolved(source: DataFrame, dims: Mapping[str, tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """Rows :func:`resolve_keys` drops, once per dimension that does not know them."""
    missing = [
        orphans(source, dim, keys).withColumn("dimension", F.lit(sk)) for sk, (dim, keys) in dims.items()
    ]
    result = missing[0]
    for other in missing[1:]:
        result = result.unionByName(other)
    return result


def key_map(old_dim: DataFrame, new_dim: DataFrame, sk: str, natural: Sequence[str]) -> DataFrame:
    """(``sk``, ``_new_sk``) pairs of two dimensions that share natural keys."""
    new = new_dim.select(F.col(sk).alias("_new_sk"), *natural)
    return sized_join(old_dim.select(sk, *natural), new, list(natural)).select(sk, "_new_sk")


def rekey(fact: DataFrame, maps: Mapping[str, DataFrame]) -> DataFrame:
    """Swap surrogate keys of one model for those of another; ``maps`` come from :func:`key_map`."""
    columns = fact.columns
    hot = {sk: skewed(fact, pairs, [sk]) for sk, pairs in maps.items()}
    for sk, pairs in maps.items():
        fact = skew_join(fact, pairs, sk, hot=hot[sk]).withColumn(sk, F.col("_new_sk")).drop("_new_sk")
    return fact.select(*columns)
