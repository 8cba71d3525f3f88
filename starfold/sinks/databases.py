"""Layers as databases: tables that SQL text finds as ``database.table``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def save_database(
    spark: SparkSession,
    database: str,
    path: str,
    tables: Mapping[str, DataFrame],
    partition_by: Mapping[str, Sequence[str]] | None = None,
    buckets: Mapping[str, tuple[int, str]] | None = None,
) -> None:
    """Replace the tables of ``database`` by parquet tables under ``path``.

    ``buckets`` maps a table to (number, column): tables bucketed alike by the
    column they are joined on are joined without a shuffle. Leave it out for a
    column some value of which holds a large share of the rows: a bucket cannot
    be split, a shuffled partition can.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{path}'")
    for name, df in tables.items():
        columns = list((partition_by or {}).get(name, ()))
        writer = (df.hint("rebalance", *columns) if columns else df).write.mode("overwrite").format("parquet")
        if columns:
            writer = writer.partitionBy(*columns)
        if name in (buckets or {}):
            number, column = buckets[name]
            writer = writer.bucketBy(number, column).sortBy(column)
        writer.option("path", f"{path}/{name}").saveAsTable(f"{database}.{name}")
