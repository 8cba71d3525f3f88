"""SimHash near-duplicates, with exact pairs from vantage-point trees.

Fingerprints lie in a tree: a node holds a vantage fingerprint and a radius, and
its two branches those within the radius and those beyond. By the triangle
inequality a fingerprint at distance d of the vantage has all its links (distance
r or less) within d - r to d + r, so a branch that this band does not touch is
pruned. The top of the tree is fitted on a bounded sample and deals all
fingerprints to shards; one whose band overlaps the boundary also visits the other
side. Shards that grow large are split into blocks of bounded size. Each block goes
on with a tree of its own, and what it finds leaves it as a spanning forest of its
links, never as all pairs of a group.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import arrow_rows, written
from .base import TEXT_ROWS
from .components import components

SHINGLE_WORDS = 4
LINK_BITS = 4
SEED = 42
#: The tree's top is fitted on at most so many fingerprints (half a megabyte), the least by hash.
SAMPLE = 65_536
#: The tree's top has about sqrt(fingerprints) / SPREAD leaves, at most 2^DEPTH. Each level lets a fingerprint visit about
#: half as many shards again, so shards grow with the input rather than only their number.
SPREAD, DEPTH = 64, 12
#: Fingerprints of a chunk of a shard; two chunks at most meet in a task.
BLOCK_ROWS = 1 << 16
#: A block's own tree stops at so many fingerprints and compares them in pieces.
LEAF, BLOCK = 256, 512


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only


def shingle_hashes(words: list[bytes], words_in_shingle: int) -> np.ndarray:
    """Hashes of all shingles in turn; of fewer words than a shingle has, the one of all of them."""
    import xxhash

    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= words_in_shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    count = len(words) - words_in_shingle + 1
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[b:e], SEED) for b, e in zip(begins[:count].tolist(), ends[words_in_shingle - 1:].tolist())), np.uint64, count)


def _majority(hashes: np.ndarray) -> int:
    votes, count = np.zeros(64, np.int64), len(hashes)
    for at in range(0, count, 1 << 14):
        octets = hashes[at:at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > count, bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, words_in_shingle: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text, 0 for one without words."""
    return _majority(shingle_hashes(_words(text), words_in_shingle))


def with_fingerprint(docs: DataFrame, words_in_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fp`` (as a signed integer) per row of ``docs``; other columns are not read."""

    @F.pandas_udf("bigint")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(t, words_in_shingle) for t in batch], dtype=np.uint64).astype(np.int64)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), of(F.col("text").cast("string")).alias("fp"))


@dataclass
class Node:
    vantage: np.uint64
    radius: int
    near: Node | int
    far: Node | int


def _distance(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int16)


def _vantage(points: np.ndarray, random: np.random.Generator) -> np.uint64:
    """Of a few candidates the one whose distances spread most, as those prune best."""
    some = random.choice(points, min(len(points), 256), replace=False)
    candidates = random.choice(points, min(len(points), 16), replace=False)
    return max(candidates, key=lambda v: (_distance(some, v).std(), int(v)))


def fit(sample: np.ndarray, shards: int, seed: int = 7) -> tuple[Node | int, int]:
    """A tree over a sample with up to ``shards`` leaves, numbered from 0; and their number."""
    random = np.random.default_rng(seed)
    leaves = 0

    def grow(points: np.ndarray, wanted: int) -> Node | int:
        nonlocal leaves
        if wanted > 1 and len(points) > 1:
            vantage = _vantage(points, random)
            away = _distance(points, vantage)
            radius = int(np.median(away))
            inside = away <= radius
            if not inside.all():
                return Node(vantage, radius, grow(points[inside], wanted // 2), grow(points[~inside], wanted - wanted // 2))
        leaves += 1
        return leaves - 1

    return grow(sample, shards), leaves


def deal(tree: Node | int, points: np.ndarray, bits: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each leaf reached: (leaf, indices of points, whether they are at home there).

    A point at home within the radius also visits the far side if its band reaches
    there; one at home beyond does not visit back, as their pair is found already.
    """
    out: list[tuple[int, np.ndarray, np.ndarray]] = []

    def walk(node: Node | int, at: np.ndarray, home: np.ndarray) -> None:
        if not len(at):
            return
        if not isinstance(node, Node):
            out.append((node, at, home))
            return
        away = _distance(points[at], node.vantage)
        inside = away <= node.radius
        near = np.where(home, inside, away - bits <= node.radius)
        far = away + bits > node.radius
        walk(node.near, at[near], home[near])
        walk(node.far, at[far], home[far] & ~inside[far])

    walk(tree, np.arange(len(points)), np.ones(len(points), bool))
    return out


class Forest:
    """Labels of points that links have joined so far; vectorised over batches of links."""

    def __init__(self, size: int):
        self.label = np.arange(size)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            la, lb = label[a], label[b]
            apart = la != lb
            if not apart.any():
                return
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            low = np.minimum(la, lb)
            np.minimum.at(label, la, low)
            np.minimum.at(label, lb, low)
            while True:
                further = label[label]
                if np.array_equal(further, label):
                    break
                label[:] = further


def shard_forest(points: np.ndarray, home: np.ndarray, bits: int = LINK_BITS, seed: int = 7, among_homes: bool = True) -> np.ndarray:
    """For each point the index of another it is joined with (or itself), over all links of a point at home with any other.

    Without ``among_homes`` only links of points at home with visitors are looked for.
    """
    forest, random = Forest(len(points)), np.random.default_rng(seed)

    def compare(queries: np.ndarray, homes: np.ndarray) -> None:
        for at in range(0, len(queries), BLOCK):
            own = queries[at:at + BLOCK]
            for to in range(0, len(homes), 16 * BLOCK):
                other = homes[to:to + 16 * BLOCK]
                i, j = np.nonzero(np.bitwise_count(points[own][:, None] ^ points[other][None, :]) <= bits)
                if len(i):
                    forest.link(own[i], other[j])

    def walk(homes: np.ndarray, visitors: np.ndarray) -> None:
        if not len(homes):
            return
        if len(homes) > LEAF:
            vantage = _vantage(points[homes], random)
            away, of_visitors = _distance(points[homes], vantage), _distance(points[visitors], vantage)
            radius = int(np.median(away))
            inside = away <= radius
            if not inside.all():
                walk(homes[inside], visitors[of_visitors - bits <= radius])
                across = homes[inside & (away + bits > radius)] if among_homes else homes[:0]
                walk(homes[~inside], np.concatenate([visitors[of_visitors + bits > radius], across]))
                return
        if among_homes:
            compare(homes, homes)
        compare(visitors, homes)

    walk(np.flatnonzero(home), np.flatnonzero(~home))
    return forest.label


class Blocks:
    """How shards are split into blocks of bounded size, each compared in a task of its own.

    Visitors let a shard grow with the input whatever the number of shards. Its
    fingerprints at home are dealt into chunks of about ``BLOCK_ROWS`` by hash, its
    visitors too, and each pair of a home chunk with itself, a later home chunk or a
    visitor chunk is a block. So every pair is compared in exactly one of them.
    """

    def __init__(self, sizes: dict[int, int]):
        """``sizes``: leaf -> fingerprints at home, ~leaf -> visitors."""
        chunks = lambda n: -(-n // BLOCK_ROWS)
        leaves = sorted(leaf for leaf in sizes if leaf >= 0)
        self.chunks = {leaf: (max(1, chunks(sizes[leaf])), chunks(sizes.get(~leaf, 0))) for leaf in leaves}
        self.first = dict(zip(leaves, np.cumsum([0, *[a * (a + b) for a, b in self.chunks.values()]]).tolist()))

    def of(self, leaf: int, points: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(block, index of the point, whether it is at home there) of every block that a point goes to."""
        homes, visitors = self.chunks[leaf]
        both, mixed = homes + visitors, (points * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        at = np.flatnonzero(home)
        chunk, other = np.repeat((mixed[at] % np.uint64(homes)).astype(np.int64), both), np.tile(np.arange(both), len(at))
        as_home = other >= chunk  # it meets earlier home chunks as their visitor
        block = np.where(as_home, chunk * both + other, other * both + chunk)
        guest = np.flatnonzero(~home)
        column = homes + (mixed[guest] % np.uint64(max(1, visitors))).astype(np.int64)
        blocks = np.concatenate([block, (np.arange(homes)[None, :] * both + column[:, None]).ravel()])
        return self.first[leaf] + blocks, np.concatenate([np.repeat(at, both), np.repeat(guest, homes)]), np.concatenate(
            [as_home, np.zeros(len(guest) * homes, bool)])

    def among_homes(self, block: int) -> bool:
        """Whether it is a block of a home chunk with itself."""
        leaf = max((leaf for leaf in self.first if self.first[leaf] <= block), key=lambda leaf: self.first[leaf])
        i, j = divmod(block - self.first[leaf], sum(self.chunks[leaf]))
        return i == j


def links(prints: DataFrame, bits: int = LINK_BITS) -> DataFrame:
    """``a, b``: links that join all of ``prints`` (distinct ``fp``) that differ in at most ``bits`` bits, as forests per block."""
    count = prints.count()
    depth = min(DEPTH, max(0, int(np.ceil(np.log2(max(1.0, np.sqrt(count) / SPREAD))))))
    chosen = prints.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).toPandas()["fp"] if depth else []
    tree, _ = fit(np.array(chosen, np.int64).view(np.uint64), 1 << depth)

    def count_dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for leaf, _, home in deal(tree, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits):
                found[leaf] += int(home.sum())
                found[~leaf] += int((~home).sum())  # visitors
        yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.int32()), pa.array(found.values(), pa.int64())], ["shard", "n"])

    sizes = prints.mapInArrow(count_dealt, "shard int, n bigint").groupBy("shard").agg(F.sum("n").alias("n")).collect()  # two rows a leaf
    blocks = Blocks({r["shard"]: r["n"] for r in sizes})

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for leaf, at, home in deal(tree, points, bits):
                block, own, as_home = blocks.of(leaf, points[at], home)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block), pa.array(points[at[own]].view(np.int64)), pa.array(as_home)], ["block", "fp", "home"])

    def in_block(table: pa.Table) -> pa.Table:
        if not len(table):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        points = table.column("fp").to_numpy().view(np.uint64)
        label = shard_forest(points, table.column("home").to_numpy(), bits, among_homes=blocks.among_homes(table.column("block")[0].as_py()))
        moved = np.flatnonzero(label != np.arange(len(label)))
        signed = points.view(np.int64)
        return pa.table({"a": signed[moved], "b": signed[label[moved]]})

    dealt = prints.mapInArrow(to_blocks, "block bigint, fp bigint, home boolean")
    return dealt.groupBy("block").applyInArrow(in_block, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, bits: int = LINK_BITS, words_in_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fp, root, component_id`` per row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Null texts and
    texts without words have fingerprint 0 and link like any other. ``root`` names
    the component by its least fingerprint, ``component_id`` by its least
    ``doc_id``; null ids do not count unless a component has no other. Equal texts
    meet in one fingerprint before anything is compared, so large groups of copies
    cost no comparisons. An empty table gives no rows.
    """
    with arrow_rows(docs.sparkSession, TEXT_ROWS):
        rows = written(with_fingerprint(docs, words_in_shingle), "simhash")
    prints = written(rows.groupBy("fp").agg(F.min("doc_id").alias("_first")), "fingerprints")
    roots = components(links(prints.select("fp"), bits))
    named = prints.join(roots, prints.fp == roots.node, "left").select(
        "fp", "_first", F.coalesce("root", "fp").alias("root"))
    first = named.groupBy("root").agg(F.min("_first").alias("component_id"))
    return rows.join(named.join(first, "root").select("fp", "root", "component_id"), "fp", "left").select(
        "doc_id", "fp", "root", "component_id")


def keep_one(docs: DataFrame, **parameters) -> DataFrame:
    """One row of each group of near-duplicates, that of the least ``doc_id``, with all its columns as they are.

    A row is found again by its position in the input, so repeated and null ids do
    no harm: of equal ids the first position stays.
    """
    columns = {name: f"_c{at}" for at, name in enumerate(docs.columns)}
    stored = written(docs.toDF(*columns.values()).withColumn("_row", F.monotonically_increasing_id()), "near-rows")
    keyed = stored.select(F.col("_row").alias("doc_id"), F.col(columns["text"]).alias("text"))
    grouped = near_duplicates(keyed, **parameters).select(F.col("doc_id").alias("_row"), "root")
    ids = stored.select("_row", F.col(columns["doc_id"]).alias("_id"))
    order = F.struct(F.col("_id").isNull(), F.col("_id"), F.col("_row"))
    kept = grouped.join(ids, "_row").groupBy("root").agg(F.min(order).alias("_best")).select(F.col("_best._row").alias("_row"))
    return stored.join(kept, "_row", "left_semi").select(*[F.col(own).alias(name) for name, own in columns.items()])
