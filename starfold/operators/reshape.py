"""Projection and row expansion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def select_values(df: DataFrame, names: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Select, rename and reorder; columns not listed are dropped."""
    pairs = names.items() if isinstance(names, Mapping) else [(n, n) for n in names]
    return df.select(*[F.col(old).alias(new) for old, new in pairs])


def retype(df: DataFrame, types: Mapping[str, T.DataType | str]) -> DataFrame:
    return df.withColumns({name: F.col(name).cast(t) for name, t in types.items()})


def add_constant(df: DataFrame, name: str, value: object, data_type: str | None = None) -> DataFrame:
    constant = F.lit(value)
    return df.withColumn(name, constant.cast(data_type) if data_type else constant)


def expand_list(df: DataFrame, name: str, values: Sequence) -> DataFrame:
    """Every row once per listed constant: a product with a list, without a join."""
    return df.select("*", F.explode(F.array(*[F.lit(v) for v in values])).alias(name))


def unpivot_exprs(
    df: DataFrame, cases: Sequence[tuple[str, Column]], label: str, value: str, keep: Sequence[str] | None = None
) -> DataFrame:
    """One row per (label, expression) pair; expressions may use the row's columns."""
    rows = F.array(*[F.struct(F.lit(name).alias(label), expr.alias(value)) for name, expr in cases])
    return df.select(*(keep if keep is not None else df.columns), F.inline(rows))
