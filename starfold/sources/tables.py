"""Parquet tables, SQL results over registered views, JDBC queries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Make DataFrames queryable by name in SQL (session-local, nothing is computed)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")


def read_query(spark: SparkSession, sql: str, **views: DataFrame) -> DataFrame:
    """Result of a SQL query; ``{name}`` placeholders stand for the given DataFrames."""
    return spark.sql(sql, **views)


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Query result over JDBC, read in parallel slices of ``partition_column`` when given.

    Spark allows no ``query`` together with a partition column, so the query
    then travels as a derived table.
    """
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_size)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column is None:
        return reader.option("query", query).load()
    if None in (lower, upper, partitions):
        raise ValueError("a partitioned read needs lower, upper and partitions")
    return (
        reader.option("dbtable", f"({query}) q")
        .option("partitionColumn", partition_column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .load()
    )


def conform(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Project onto a declared schema: its columns, order and types.

    A declared column the input lacks is an error; columns it has besides are dropped.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from input: {missing}")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
