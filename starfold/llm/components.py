"""Connected components of links, by rounds of star operations on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written


def _state(pairs: DataFrame):
    return pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("high", "low").cast("decimal(20,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """``node, root``: the least node reachable, for each node of ``links`` (``a``, ``b``) that has a link.

    A round lets every node point its larger neighbours to the least of its
    neighbourhood, then point itself and its smaller ones there; the number of
    rounds grows with the logarithm of a component's size. Least neighbours are
    aggregates that combine before the shuffle, and the joins are plain inner joins
    on stored pairs, which AQE splits where one node has very many links. Each
    round is written to the shared folder, so no lineage builds up.
    """
    pairs = written(
        links.where("a != b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct(), "links")
    before, state = None, _state(pairs)
    while state[0] and state != before:
        both = pairs.select(F.col("high").alias("u"), F.col("low").alias("v")).union(pairs.select("low", "high"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("high"), F.col("m").alias("low")).distinct()
        lowest = large.groupBy("high").agg(F.min("low").alias("m"))
        small = large.join(lowest, "high").where("low != m").select(F.col("low").alias("high"), F.col("m").alias("low"))
        pairs = written(small.union(lowest.select("high", "m")).distinct(), "links")
        before, state = state, _state(pairs)
    return pairs.select(F.col("high").alias("node"), F.col("low").alias("root")).union(
        pairs.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct())
