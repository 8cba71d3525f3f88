"""Conditional split into two targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from ..functions.numbers import flag


def route(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected); an unknown (NULL) predicate rejects.

    Both branches read ``df``. When it is costly, tag it with :func:`tagged`,
    write it once partitioned by the tag and read the two parts back.
    """
    accepted = flag(predicate)
    return df.filter(accepted), df.filter(~accepted)


def tagged(df: DataFrame, predicate: Column, name: str = "ok") -> DataFrame:
    """One pass instead of two: the outcome as a boolean column."""
    return df.withColumn(name, flag(predicate))
