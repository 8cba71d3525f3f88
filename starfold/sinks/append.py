"""Append-only sinks."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import CODEC


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def append_rejects(df: DataFrame, path: str, run_id: str) -> bool:
    """Append all incoming fields, tagged with the run so that reruns can be told apart; whether anything was written.

    A run's rejects are logged once: when they are written, a mark is set beside
    them, and a repeated call with the same ``run_id`` does nothing. An attempt that
    failed before its mark is replaced by the next one, as it went to the run's own folder.
    """
    spark = df.sparkSession
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_runs/{quote(run_id, safe='')}")
    fs = mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(mark):
        return False
    tagged = df.withColumn("run_id", F.lit(run_id))
    tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)
    fs.create(mark, True).close()
    return True


def read_rejects(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The reject log of rows of ``schema``; it may be empty."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("run_id", T.StringType())])).parquet(path)


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "errorifexists", gather: bool = True) -> None:
    """Write by partition without a flood of small files.

    REBALANCE gathers the rows of a partition value, splits the values that are
    too large and merges those too small, at run time. It moves every row: without
    ``gather`` each task writes its rows where they are, one file for each value it
    holds, which suits few values in large tasks, and rows read from files that are
    partitioned alike.
    """
    rows = df.hint("rebalance", *partition_by) if gather else df
    rows.write.mode(mode).option("compression", CODEC).partitionBy(*partition_by).parquet(path)
