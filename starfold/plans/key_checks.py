"""Unique and foreign keys of a load, checked against a stored summary of keys instead of the whole table.

The summary holds each key once with its number of rows, in parts by ranges of the
key. A load is grouped by itself, and only the parts that its keys fall into are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import any_null, skew_join
from ..operators.quality import ForeignKey, key_counts, missing_parents, repeated_keys
from ..session import written
from ..sinks import Load, merge_parts, touched_rows, write_parts


def check_unique(load: Load, summary: str, batch: DataFrame, keys: Sequence[str], rows_per_part: int = 1_000_000) -> DataFrame:
    """Keys of ``batch`` that occur more than once in it and all batches before, with their count (as ``duplicate_keys``).

    The batch's keys are added to ``summary`` by this load, rejected or not: take
    rejected rows out of the batch and check it again in a load of its own.
    """
    keys = list(keys)
    counts = written(key_counts(batch, keys), "key-counts")
    if summary not in load:
        write_parts(load, summary, counts, keys, rows_per_part)
        return repeated_keys(counts, keys)
    known = touched_rows(load, summary, counts).withColumnRenamed("n", "_n")
    total = written(skew_join(counts, known, keys, "left").select(*keys, (F.col("n") + F.coalesce("_n", F.lit(0))).alias("n")), "key-totals")
    merge_parts(load, summary, total)
    return repeated_keys(total, keys)


def all_repeated(load: Load, summary: str) -> DataFrame:
    """The report over everything loaded so far, from the summary alone: nothing is grouped."""
    return repeated_keys(load.read(summary), load.note(summary)["keys"])


def check_references(load: Load, summary: str, batch: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose non-NULL reference ``columns`` is no key of ``summary`` (as ``missing_parents``)."""
    own = load.note(summary)["keys"]
    asked = batch.filter(~any_null(columns)).select(*[F.col(c).alias(k) for c, k in zip(columns, own)]).distinct()
    return missing_parents(batch, key, ForeignKey(columns, touched_rows(load, summary, asked), own))
