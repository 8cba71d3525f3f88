"""Dense surrogate keys in the order of the natural key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir, written
from .joins import is_small

_PARTITION_BITS = 33


def assign_sk(df: DataFrame, sk: str, order: Sequence[Column | str], start: int = 1, bounded: bool = False) -> DataFrame:
    """Number the rows ``start, start+1, ...`` in ``order`` (a total order) as column ``sk``.

    ``bounded`` is for dimensions whose size cannot follow the data, such as a
    calendar: one window over all rows. Everything else is range-partitioned by
    the order, numbered inside each partition and shifted by the sizes of the
    partitions before it; the only global step sees one row per partition.
    """
    if bounded:
        number = F.row_number().over(Window.orderBy(*order)) + F.lit(start - 1)
        return df.select(number.cast("bigint").alias(sk), "*")
    shared_dir(df.sparkSession)
    # The checkpoint fixes partition boundaries: both readers below must see the same ones.
    ranged = df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_id", _PARTITION_BITS)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    within = F.col("_id") - F.shiftleft(F.col("_part"), _PARTITION_BITS)
    return (
        ranged.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # one row per range partition
        .select((F.col("_offset") + within + F.lit(start)).cast("bigint").alias(sk), *df.columns)
    )


def number_dimension(df: DataFrame, sk: str, order: Sequence[Column | str]) -> DataFrame:
    """:func:`assign_sk` for a dimension, whose size is seen after its rows are written once.

    One that Spark would broadcast is numbered in one task; any larger one by ranges.
    """
    rows = written(df, f"rows-{sk}")
    return assign_sk(rows, sk, order, bounded=is_small(rows))
