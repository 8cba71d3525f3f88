"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns a number of arcs of a ring of hashes. A document belongs to the
arc that its text's hash falls into, and goes to that arc's shard, unless the shard
is full: then it continues clockwise to the next virtual node whose shard has room.
Capacities add up to the number of documents, so all shards end up full and their
counts differ by one at most, while only what exceeds a capacity leaves its arc.

Arcs are few, documents many: how many of each arc's documents every shard takes
follows from the arcs' counts alone. Documents are numbered in the order of the
ring, so their place within the arc tells shard and slot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import assign_sk
from ..session import written

SHARDS = 8
#: Virtual nodes of each shard. The more, the more even are the arcs and the fewer documents have to go on.
VIRTUAL_NODES = 128
LAW = "rows"


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the virtual nodes in clockwise order, and the shard of each; a shard's nodes do not depend on the others."""
    nodes = sorted(
        (int.from_bytes(hashlib.blake2b(f"{shard}/{node}".encode(), digest_size=8).digest(), "big", signed=True), shard)
        for shard in range(shards) for node in range(virtual_nodes))
    return np.array([at for at, _ in nodes], np.int64), np.array([shard for _, shard in nodes], np.int64)


def capacities(count: int, shards: int) -> list[int]:
    """As even as can be; the first shards take what is left over."""
    return [count // shards + (shard < count % shards) for shard in range(shards)]


def flow(counts: Sequence[int], owners: Sequence[int], room: Sequence[int]) -> list[tuple[int, int, int, int]]:
    """``(arc, first, count, shard)``: which documents of every arc, counted from ``first``, which shard takes.

    ``counts`` are the arcs' documents in clockwise order. In each round what waits
    asks the shard of the node it has reached; what does not fit goes on clockwise to
    the next node whose shard has room. A round either ends the work or fills a
    shard, so there are no more rounds than shards.
    """
    room, arcs = list(room), len(counts)
    waiting = [(arc, 0, count, arc) for arc, count in enumerate(counts) if count]
    taken = []
    while waiting:
        later = []
        for arc, first, count, at in waiting:
            some = min(count, room[owners[at]])
            if some:
                taken.append((arc, first, some, int(owners[at])))
                room[owners[at]] -= some
            if some < count:
                later.append((arc, first + some, count - some, at))
        waiting = [(arc, first, count, next(k % arcs for k in range(at + 1, at + arcs + 1) if room[owners[k % arcs]])) for arc, first, count, at in later]
    return sorted(taken)


def _positions(docs: DataFrame, row: Column, bounds: np.ndarray) -> DataFrame:
    """``_row, doc_id, size, text_crc32, _at, _arc`` per row of ``docs``: the hash of its text and the arc it falls into."""

    @F.pandas_udf("int")
    def arc(hashes: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in hashes:  # a node ends the arc before it; what lies beyond the last node belongs to the first
            yield pd.Series(np.searchsorted(bounds, batch.to_numpy(), "left") % len(bounds)).astype("int32")

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        row.alias("_row"), F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("_at"))
    return written(rows.withColumn("_arc", arc("_at")), "ring-positions")


def _placed(rows: DataFrame, shards: int, virtual_nodes: int) -> DataFrame:
    spark = rows.sparkSession
    _, owners = ring(shards, virtual_nodes)
    counts = [0] * len(owners)
    for r in rows.groupBy("_arc").count().collect():  # a row for each virtual node at most
        counts[r["_arc"]] = r["count"]
    filled, begins = [0] * shards, np.concatenate(([0], np.cumsum(counts))).tolist()
    pieces = []
    for arc, first, count, shard in flow(counts, owners, capacities(sum(counts), shards)):
        pieces.append((arc, begins[arc] + first, begins[arc] + first + count, shard, filled[shard] - begins[arc] - first))
        filled[shard] += count
    table = spark.createDataFrame(pieces, "_arc int, _from bigint, _to bigint, shard int, _shift bigint")
    numbered = assign_sk(rows, "_number", ["_arc", "_at", F.col("doc_id").asc_nulls_last(), "_row"], start=0)
    # an arc is cut only where it fills a shard: no more pieces than virtual nodes and shards, whatever the number of documents
    found = numbered.join(F.broadcast(table), "_arc").where((F.col("_number") >= F.col("_from")) & (F.col("_number") < F.col("_to")))
    return found.select("_row", "doc_id", "size", "text_crc32", "shard", (F.col("_number") + F.col("_shift")).alias("slot"))


def place(docs: DataFrame, shards: int = SHARDS, virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` per row of ``docs``; the law is ``rows``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. ``size`` is
    the text's bytes in UTF-8 and one more; a null text is an empty one. Equal texts
    have the same place on the ring and stay in one shard as far as it has room; a
    group of copies that is larger than a shard goes on clockwise. Within a place
    documents go by ``doc_id``, null last, then by position in the table; repeated
    rows are placed each. With fewer documents than shards the last shards are
    empty; an empty table gives no rows. ``grown_shard`` is null under this law. Only
    narrow rows are sorted; texts are read once and not moved.
    """
    if shards < 1 or virtual_nodes < 1:
        raise ValueError("a ring needs shards and virtual nodes")
    bounds, _ = ring(shards, virtual_nodes)
    found = _placed(_positions(docs, F.monotonically_increasing_id(), bounds), shards, virtual_nodes)
    return found.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, virtual_nodes: int = VIRTUAL_NODES) -> None:
    """Write the rows of ``docs`` with all their columns to ``path``, a folder for each shard; ``_slot`` orders a shard's rows.

    Columns of ``docs`` called ``_shard`` or ``_slot`` are an error. Rows go to
    several files a shard, in ranges of the slot, so no task holds a shard.
    """
    if {"_shard", "_slot"} & set(docs.columns):
        raise ValueError("the table has columns _shard or _slot already")
    bounds, _ = ring(shards, virtual_nodes)
    columns = {name: f"_c{at}" for at, name in enumerate(docs.columns)}
    stored = written(docs.toDF(*columns.values()).withColumn("_id", F.monotonically_increasing_id()), "ring-rows")
    keyed = stored.select("_id", F.col(columns["doc_id"]).alias("doc_id"), F.col(columns["text"]).alias("text"))
    places = _placed(_positions(keyed, F.col("_id"), bounds), shards, virtual_nodes).select(
        F.col("_row").alias("_id"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    joined = stored.join(places, "_id").select(*[F.col(own).alias(name) for name, own in columns.items()], "_shard", "_slot")
    joined.repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot").write.partitionBy("_shard").parquet(path)


def read_shard(spark: SparkSession, path: str, shard: int, schema: str) -> DataFrame:
    """The rows of one shard with their ``_slot``; ``schema`` is that of the table written. A shard without rows is empty."""
    return spark.read.schema(f"{schema}, _shard int, _slot bigint").parquet(path).where(F.col("_shard") == shard).drop("_shard")
