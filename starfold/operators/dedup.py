"""One row per group, chosen by a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = "_rank"


def top1_per_group(df: DataFrame, partition: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row of each group in ``order``, which must leave no ties.

    Spark turns ``row_number() = 1`` into a group limit before the shuffle, so
    each task sends one row per group and a hot group never meets in one place.
    """
    ranked = df.withColumn(RANK, F.row_number().over(Window.partitionBy(*partition).orderBy(*order)))
    return ranked.filter(F.col(RANK) == 1).drop(RANK)


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """Deduplicate on ``keys`` keeping the first row in ``order_by`` (deterministic, unlike dropDuplicates)."""
    return top1_per_group(df, keys, order_by)
