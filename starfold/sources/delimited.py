"""Delimited text with declared types and locale-aware numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import locale_number


def read_csv_typed(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    sep: str = ";",
    decimal: str = ",",
    group: str = ".",
    header: bool = True,
    date_format: str = "yyyy-MM-dd",
) -> DataFrame:
    """Read CSV with a declared schema; numbers use ``decimal`` and ``group`` symbols.

    Numbers come in as text and are converted by column expressions, so the scan
    stays splittable and prunes unused columns. Unparsable values become NULL:
    :func:`read_csv_checked` keeps their text.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    numeric = {f.name for f in schema.fields if isinstance(f.dataType, T.NumericType)}
    as_text = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in numeric else f.dataType) for f in schema.fields]
    )
    raw = (
        spark.read.schema(as_text)
        .option("sep", sep)
        .option("header", header)
        .option("dateFormat", date_format)
        .option("encoding", "UTF-8")
        .csv(path)
    )
    return raw.select(
        [
            locale_number(f.name, f.dataType.simpleString(), decimal, group).alias(f.name)
            if f.name in numeric
            else F.col(f.name)
            for f in schema.fields
        ]
    )


def read_csv_checked(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    sep: str = ";",
    decimal: str = ",",
    group: str = ".",
    header: bool = True,
    date_format: str = "yyyy-MM-dd",
) -> DataFrame:
    """As :func:`read_csv_typed`, with ``errors``: a map of the columns that cannot be read to their text.

    Rows without errors are accepted, the others go to the reject log; none is
    lost. An empty field is NULL, not an error.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = spark.read.schema(text).option("sep", sep).option("header", header).option("encoding", "UTF-8").csv(path)

    def typed(f: T.StructField):
        if isinstance(f.dataType, T.NumericType):
            return locale_number(f.name, f.dataType.simpleString(), decimal, group)
        if isinstance(f.dataType, T.DateType):
            return F.try_to_date(F.col(f.name), date_format)
        return F.col(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name).try_cast(f.dataType)

    wrong = [
        F.when(F.trim(f.name) != "", F.when(typed(f).isNull(), F.struct(F.lit(f.name).alias("key"), F.col(f.name).alias("value"))))
        for f in schema.fields]
    return raw.select(*[typed(f).alias(f.name) for f in schema.fields], F.map_from_entries(F.array_compact(F.array(*wrong))).alias("errors"))
