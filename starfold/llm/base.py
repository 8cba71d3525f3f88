"""Where the queries of this subpackage are registered, and what several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Rows with whole texts that tasks of Python take at a time.
TEXT_ROWS = 512

#: What separates words where a contract speaks of words: blank, tab to carriage return.
WORD = "[^\\x20\\x09-\\x0D]+"


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function of (spark, folder of tables) as ``name``; ``sql`` is its equivalent in DuckDB."""

    def add(build: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def word_count(text: str):
    """Number of words of a text column, 0 for null: the runs of the other characters are dropped and one counts starts."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")
