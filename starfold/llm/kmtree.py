"""Nearest neighbours by inner product from a hierarchical k-means tree.

The tree is fitted on a bounded sample; every vector is dealt to the leaf of its
nearest centres. Vectors get one more component that gives all the same length, so
the largest inner product is the least distance and the tree's centres order
leaves for either. A query visits leaves best bin first: a priority queue of
branches by distance to their centre. How many leaves it visits is calibrated: a
bounded set of queries is answered by brute force over all vectors in blocks, and
the visits are widened until the found share of true neighbours reaches the recall
asked for. A query whose leaves hold too few vectors for a full answer goes on.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

NEIGHBOURS = 20
BRANCHES = 16
#: The tree is fitted on at most so many vectors, the least by hash of id and vector.
SAMPLE = 16_384
#: Vectors in a leaf, about; a leaf that gets more is split over tasks in such parts.
LEAF, PART = 256, 8192
CALIBRATION_QUERIES = 256
RECALL = 0.95


@dataclass
class Tree:
    """A node: the centres of its branches, and the branches or else the leaf's number."""

    centres: np.ndarray | None = None
    branches: list[Tree] = field(default_factory=list)
    leaf: int = -1


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None, :]


def _k_means(points: np.ndarray, k: int, random: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centres = points[random.choice(len(points), k, replace=False)]
    for _ in range(rounds):
        nearest = _distances(points, centres).argmin(1)
        sizes = np.bincount(nearest, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return centres


def fit(sample: np.ndarray, leaves: int, seed: int = 11) -> tuple[Tree, int]:
    """A tree with about ``leaves`` leaves over a sample, and how many it has."""
    random, count = np.random.default_rng(seed), 0

    def grow(points: np.ndarray, wanted: int) -> Tree:
        nonlocal count
        k = min(BRANCHES, wanted)
        if k > 1 and len(np.unique(points, axis=0)) >= 2 * k:
            centres = _k_means(points, k, random)
            nearest = _distances(points, centres).argmin(1)
            used = np.unique(nearest)
            if len(used) > 1:
                share = [max(1, round(wanted * (nearest == c).mean())) for c in used]
                return Tree(centres[used], [grow(points[nearest == c], s) for c, s in zip(used, share)])
        count += 1
        return Tree(leaf=count - 1)

    return grow(sample, leaves), count


def leaf_of(tree: Tree, points: np.ndarray) -> np.ndarray:
    """The leaf of each point, by its nearest centre at each level."""
    out = np.empty(len(points), np.int32)

    def walk(node: Tree, at: np.ndarray) -> None:
        if node.centres is None:
            out[at] = node.leaf
            return
        nearest = _distances(points[at], node.centres).argmin(1)
        for number, branch in enumerate(node.branches):
            if len(own := at[nearest == number]):
                walk(branch, own)

    walk(tree, np.arange(len(points)))
    return out


def best_bins(tree: Tree, point: np.ndarray, visits: int, sizes: dict[int, int] | None = None, wanted: int = 0) -> list[int]:
    """The first ``visits`` leaves of a best-bin-first walk, and as many more as it takes to hold ``wanted`` vectors by ``sizes``."""
    queue, found, ties, held = [(0.0, 0, tree)], [], 0, 0
    while queue and (len(found) < visits or held < wanted):
        _, _, node = heapq.heappop(queue)
        if node.centres is None:
            found.append(node.leaf)
            held += sizes.get(node.leaf, 0) if sizes else 0
            continue
        for distance, branch in zip(_distances(point[None, :], node.centres)[0], node.branches):
            ties += 1
            heapq.heappush(queue, (float(distance), ties, branch))
    return found


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Of rows in pairs, in double precision and summed in the order of components, so equal vectors score alike everywhere."""
    out = np.zeros(len(left))
    for component in range(left.shape[1]):
        out += left[:, component] * right[:, component]
    return out


def _nearest(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> pd.DataFrame:
    """The ``k`` nearest of a block to each query, ties to the smaller id, the query's own row left out.

    Matrix products find the candidates, with a margin far above their rounding;
    the candidates are then scored exactly.
    """
    parts = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    lengths = np.sqrt((vectors**2).sum(1)).max(initial=0.0) * np.sqrt((queries**2).sum(1))
    for at in range(0, len(queries), 256):
        own = query_ids[at:at + 256]
        rough = queries[at:at + 256] @ vectors.T
        rough[own[:, None] == ids[None, :]] = -np.inf
        least = np.partition(rough, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) > k else np.full(len(own), -np.inf)
        row, near = np.nonzero((rough >= (least - 1e-9 * lengths[at:at + 256])[:, None]) & (rough > -np.inf))
        score = inner_products(queries[at + row], vectors[near])
        order = np.lexsort((ids[near], -score, row))
        row, near, score = row[order], near[order], score[order]
        kept = np.arange(len(row)) - np.searchsorted(row, row) < k
        parts.append((own[row[kept]], ids[near[kept]], score[kept]))
    query_id, vec_id, score = (np.concatenate(column) for column in zip(*parts))
    return pd.DataFrame({"query_id": query_id, "vec_id": vec_id, "score": score})


def _nothing() -> pd.DataFrame:
    return pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})


_FOUND = "query_id bigint, vec_id bigint, score double"


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(flat), -1) if len(flat) else np.empty((0, 1))


def _top(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each query; a group limit keeps at most ``k`` per task before the shuffle."""
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def usable(vectors: DataFrame, dimensions: int | None = None) -> DataFrame:
    """``vec_id, v`` (doubles) of the vectors that take part: not null, not zero, all components finite, an id."""
    doubles = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = doubles.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    return kept if dimensions is None else kept.where(F.size("v") == dimensions)


def search(vectors: DataFrame, is_query, k: int = NEIGHBOURS, recall: float = RECALL) -> tuple[DataFrame, dict]:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found to each query, and what calibration measured.

    ``vectors`` needs ``vec_id`` and ``embedding``; ``is_query`` is a condition on
    ``vec_id``. Other columns are ignored. Vectors that are null, zero or hold null
    or non-finite components take no part, nor do those whose length is not the
    most frequent one, or rows without an id. A repeated row is a candidate each
    time it occurs; as a query it counts once. Equal scores go to the smaller id.
    An empty table gives no rows. Leaves that hold very many vectors (one vector
    with a third of all rows, say) are searched in parts by several tasks.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    lengths = usable(vectors).groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if lengths is None:
        return empty, {"leaves": 0, "visits": 0, "recall": 1.0}
    rows = written(usable(vectors, lengths["n"]), "vectors")
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("m")).first()
    count, longest = stats["n"], float(stats["m"])

    def lifted(v: np.ndarray) -> np.ndarray:
        return np.column_stack([v, np.sqrt(np.maximum(0.0, longest - (v**2).sum(1)))])

    def raised(v: np.ndarray) -> np.ndarray:  # a query has nothing in the added component
        return np.column_stack([v, np.zeros(len(v))])

    sample = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(SAMPLE).select("v").toArrow()
    tree, leaves = fit(lifted(_matrix(sample.column("v"))), max(1, min(count // LEAF, SAMPLE // 16)))

    def to_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = leaf_of(tree, lifted(_matrix(batch.column(1)))) if batch.num_rows else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), *batch.columns], ["leaf", "vec_id", "v"])

    index = written(rows.mapInArrow(to_leaves, "leaf int, vec_id bigint, v array<double>"), "leaves")
    sizes = {r["leaf"]: r["count"] for r in index.groupBy("leaf").count().collect()}  # as many as leaves, at most SAMPLE / 16
    queries = rows.where(is_query).groupBy("vec_id").agg(F.first("v").alias("v"), F.count(F.lit(1)).alias("own"))
    visits, measured = _calibrate(index, queries, tree, leaves, raised, k, recall)
    shards = _shards(sizes)

    def to_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = raised(_matrix(batch.column(1))) if batch.num_rows else np.empty((0, 1))
            at, shard, visited = [], [], []
            for row, (point, own_rows) in enumerate(zip(v, batch.column(2).to_pylist())):  # its own rows are no candidates
                by_shard: dict[int, list[int]] = {}
                for leaf in best_bins(tree, point, visits, sizes, k + own_rows):
                    for number in shards.get(leaf, ()):
                        by_shard.setdefault(number, []).append(leaf)
                for number, own in by_shard.items():
                    at.append(row), shard.append(number), visited.append(own)
            taken = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), pa.array(visited, pa.list_(pa.int32())), batch.column(0).take(taken), batch.column(1).take(taken)],
                ["shard", "leaves", "query_id", "q"])

    dealt = queries.select("vec_id", "v", "own").mapInArrow(to_shards, "shard int, leaves array<int>, query_id bigint, q array<double>")
    places = F.element_at(F.create_map(*[x for leaf, own in shards.items() for x in (F.lit(leaf), F.array(*map(F.lit, own)))]), F.col("leaf"))
    stored = index.select("leaf", "vec_id", "v", F.get(places, F.pmod(F.xxhash64("vec_id"), F.size(places).cast("bigint")).cast("int")).alias("shard"))

    def in_shard(_, of_queries: pa.Table, of_vectors: pa.Table) -> pa.Table:
        found = [_nothing()]
        if len(of_queries) and len(of_vectors):
            query_ids, q = of_queries.column("query_id").to_numpy(), _matrix(of_queries.column("q"))
            ids, v, leaf = of_vectors.column("vec_id").to_numpy(), _matrix(of_vectors.column("v")), of_vectors.column("leaf").to_numpy()
            visits_of: dict[int, list[int]] = {}
            for row, own in enumerate(of_queries.column("leaves").to_pylist()):
                for number in own:
                    visits_of.setdefault(number, []).append(row)
            for number, rows_here in visits_of.items():
                mine = leaf == number
                if mine.any():
                    found.append(_nearest(query_ids[rows_here], q[rows_here], ids[mine], v[mine], k))
        every = pd.concat(found, ignore_index=True).sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        return pa.Table.from_pandas(every.groupby("query_id", sort=False).head(k), preserve_index=False)

    found = dealt.groupBy("shard").cogroup(stored.groupBy("shard")).applyInArrow(in_shard, _FOUND)
    return _top(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), {
        "leaves": leaves, "visits": visits, "recall": measured}


def _shards(sizes: dict[int, int]) -> dict[int, list[int]]:
    """The shards of each leaf: neighbouring small leaves share one of about ``PART`` vectors, a larger leaf is split over several.

    A query then brings home one short list from each shard it visits, not one from each leaf.
    """
    out: dict[int, list[int]] = {}
    number, filled = 0, 0
    for leaf, size in sorted(sizes.items()):
        if size > PART:
            number += filled > 0
            parts = -(-size // PART)
            out[leaf], number, filled = list(range(number, number + parts)), number + parts, 0
            continue
        if filled and filled + size > PART:
            number, filled = number + 1, 0
        out[leaf], filled = [number], filled + size
    return out


def _calibrate(index: DataFrame, queries: DataFrame, tree: Tree, leaves: int, raised, k: int, recall: float) -> tuple[int, float]:
    """The number of leaf visits, widened by a quarter each time, at which a sample of queries has the recall asked for.

    Each task answers the sample by brute force over its own block of vectors and
    hands on its best; the true neighbours' leaves are then looked up in the order
    of each query's walk.
    """
    some = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATION_QUERIES).toArrow()
    if not len(some) or leaves == 1:
        return leaves, 1.0
    ids, points = some.column("vec_id").to_numpy(), _matrix(some.column("v"))

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = _nearest(ids, points, batch.column(1).to_numpy(), _matrix(batch.column(2)), k)
                leaf = dict(zip(batch.column(1).to_pylist(), batch.column(0).to_pylist()))
                yield pa.RecordBatch.from_pandas(found.assign(leaf=found["vec_id"].map(leaf).astype("int32")), preserve_index=False)

    true = _top(index.select("leaf", "vec_id", "v").mapInArrow(block, _FOUND + ", leaf int"), k).select("query_id", "leaf").toPandas()
    places = {q: {leaf: at for at, leaf in enumerate(best_bins(tree, p, leaves))} for q, p in zip(ids.tolist(), raised(points))}
    place = np.array([places[q][leaf] for q, leaf in zip(true["query_id"], true["leaf"])])
    visits = 1
    while (measured := float((place < visits).mean()) if len(place) else 1.0) < recall and visits < leaves:
        visits = min(leaves, visits + max(1, visits // 4))
    return visits, measured
