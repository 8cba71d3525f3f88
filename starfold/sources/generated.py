"""Generated relations: integer series and inline rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def series(spark: SparkSession, start: int, end: int, name: str = "g") -> DataFrame:
    """Integers ``start`` to ``end``, both included."""
    return spark.range(start, end + 1).withColumnRenamed("id", name)


def inline_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A constant relation written out in code; its size is fixed by the caller's source.

    It is a literal of the plan, so Catalyst knows how small it is.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not rows:
        return spark.createDataFrame([], schema)
    literals = [
        F.struct(*[F.lit(value).cast(f.dataType).alias(f.name) for value, f in zip(row, schema.fields)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*literals)))
