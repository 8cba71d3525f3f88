"""Where the modules of this package put their queries and SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..plans.retail import warehouse
from ..plans.warehouse import Warehouse
from ..sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Source:
    """The given tables of one folder: ``src.lineitem``, and the warehouse over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)

    @property
    def warehouse(self) -> Warehouse:
        return warehouse(self.spark, self.folder)


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function of a :class:`Source` under ``name``; ``sql`` is its equivalent."""

    def add(build: Callable[[Source], DataFrame]) -> Callable[[Source], DataFrame]:
        QUERIES[name] = lambda spark, folder: build(Source(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add
