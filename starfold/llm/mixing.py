"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected in the mix ``target / source_size`` times.
Within the source these expectations are summed up in the order of size, one
random offset is added, and a document is taken once per integer boundary that
its interval crosses. As the order is by size, the words taken differ from the
target by less than the source's longest document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keys import assign_sk
from ..session import written
from .base import word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
SEED = "mix-1"
_GRID = 1 << 20


def target_sizes(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Add ``target`` to ``sources`` (``source``, ``source_size``), one row per source.

    Sources by code point, null last, take the weights in turn. They share
    ``share`` times all sizes in proportion to weight, none above ``cap`` times its
    own size; what exceeds a cap is shared again by the others. The sources that
    end at their cap are those of the least cap per weight, so one pass in that
    order finds them. The windows run over sources, not over documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sources.withColumn("_weight", F.array(*map(F.lit, weights))[turn].cast("double"))
    weighed = weighed.withColumn("_cap", (F.col("source_size") * cap).cast("double"))
    order = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    ) / F.sum("_weight").over(after)
    ranked = weighed.withColumn("_level", level).withColumn("_rank", F.row_number().over(order))
    open_rank = F.when(F.col("_level") * F.col("_weight") < F.col("_cap"), F.col("_rank"))
    found = ranked.withColumn("_first", F.min(open_rank).over(everything))
    final = F.max(F.when(F.col("_rank") == F.col("_first"), F.col("_level"))).over(everything)
    return found.select(
        "source", "source_size",
        F.when(F.col("_rank") >= F.col("_first"), F.col("_weight") * final).otherwise(F.col("_cap")).alias("target"))


def offset_of(source: str, seed: str = SEED) -> Column:
    """The random offset of a source, from 0 to below 1 on a grid of 2^-20, the same in each run."""
    name = F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + "/"), name)), 1, 5), 16, 10).cast("double") / _GRID


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` per row of ``docs``.

    ``docs`` needs ``doc_id``, ``text`` and ``source``; other columns are ignored.
    Null and empty texts have size 0, are expected as often as the others of their
    source and add no words; a source without words has target 0 and no copies.
    Rows of equal size go by ``doc_id``, null last, and equal rows are
    interchangeable. An empty table gives no rows. Texts are read once, only
    narrow rows are sorted, and a hot source spreads over many range partitions.
    """
    sizes = written(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
        word_count("text").alias("size")), "mix-sizes")
    order = [F.col("source").asc_nulls_last(), "size", F.col("doc_id").asc_nulls_last()]
    numbered = assign_sk(sizes, "_number", order)
    totals = numbered.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("_number").alias("_first"))
    targets = target_sizes(totals.select("source", "source_size"), weights, share, cap)
    sources = totals.drop("source_size").alias("t").join(targets.alias("g"), F.expr("t.source <=> g.source")).select(
        F.col("t.source").alias("_source"), "_first", "source_size", "target")
    sources = sources.withColumn("_rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    rank = (F.col("_number") - F.col("_first")).cast("double")
    start = offset_of("source", seed)
    crossed = F.floor(start + F.col("_rate") * (rank + 1)) - F.floor(start + F.col("_rate") * rank)
    rows = numbered.join(sources, numbered.source.eqNullSafe(sources._source))
    copies = F.least(crossed, F.ceil("_rate")).cast("bigint")  # rounding never adds a copy
    return rows.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies")).withColumn(
        "taken", F.col("copies") * F.col("size"))


def mixed(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` themselves, each as often as the mix takes it, with its columns as they are.

    A row is found again by its position in the input, so repeated and null ids do no harm.
    """
    names = docs.columns
    columns = {name: f"_c{at}" for at, name in enumerate(names)}
    stored = written(docs.toDF(*columns.values()).withColumn("_row", F.monotonically_increasing_id()), "mix-rows")
    keyed = stored.select(F.col("_row").alias("doc_id"), F.col(columns["text"]).alias("text"), F.col(columns["source"]).alias("source"))
    taken = mix(keyed, **parameters).where("copies > 0").select(F.col("doc_id").alias("_row"), "copies")
    repeated = stored.join(taken, "_row").select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy"))
    return repeated.select(*[F.col(own).alias(name) for name, own in columns.items()])
