"""Token ids in files of shuffled planes.

File format: a Parquet table with one row per chunk of ``CHUNK_IDS`` ids. The ids
of a chunk are transposed into byte planes (all lowest bytes, then all second
bytes, ...) or bit planes (all lowest bits, ...), each plane compressed with
zstandard on its own: the high planes of small ids are nearly constant and almost
vanish. A row is also the chunk's index: its shard (the task that wrote it), its
number, where it begins, how many of its first ids belong to a document of the
chunk before, and for each document that begins in it the id, place and length.
Reading the index columns alone prunes the planes. Spark commits the files, so
they may lie in any store it can write, and a lost executor's part is written again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import arrow_rows
from .base import TEXT_ROWS
from .tokens import shared

CHUNK_IDS = 65_536
END_ID = 2
LEVEL = 3

SCHEMA = ("shard int, chunk bigint, first bigint, n_ids int, head int, ordinal bigint, doc_ids array<bigint>, "
          "begins array<bigint>, lengths array<bigint>, width string, planes array<binary>")
_ARROW = pa.schema([
    ("shard", pa.int32()), ("chunk", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int32()), ("head", pa.int32()),
    ("ordinal", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("begins", pa.list_(pa.int64())),
    ("lengths", pa.list_(pa.int64())), ("width", pa.string()), ("planes", pa.list_(pa.binary()))])


def to_planes(ids: np.ndarray, width: str = "byte") -> list[bytes]:
    """The compressed planes of unsigned 32-bit ids, lowest first."""
    pack = zstandard.ZstdCompressor(level=LEVEL).compress
    octets = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    if width == "byte":
        return [pack(np.ascontiguousarray(plane).tobytes()) for plane in octets]
    return [pack(np.packbits(plane >> bit & 1, bitorder="little").tobytes()) for plane in octets for bit in range(8)]


def from_planes(planes: list[bytes], n_ids: int, width: str = "byte") -> np.ndarray:
    """The ids of :func:`to_planes`."""
    raw = [np.frombuffer(zstandard.ZstdDecompressor().decompress(p), np.uint8) for p in planes]
    if width != "byte":
        bits = [np.unpackbits(plane, count=n_ids, bitorder="little") for plane in raw]
        raw = [sum((bits[8 * octet + bit] << bit for bit in range(8)), np.zeros(n_ids, np.uint8)) for octet in range(4)]
    return np.ascontiguousarray(np.stack(raw, axis=1)).view("<u4").reshape(-1)


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, chunk_ids: int = CHUNK_IDS,
              width: str = "byte") -> None:
    """Encode whole texts and write their ids to ``path`` in ascending ``doc_id`` order.

    Null ids come last; rows of equal id follow the hash of their text. A null or
    empty text is its end id alone. An empty table writes a table without chunks.
    Only the id and the text travel through the sort, and equal rows may lie in
    several shards.
    """
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = shared(tokenizer), TaskContext.get().partitionId()
        encoder.begin(path)
        waiting, first, chunk, ordinal, total = bytearray(), 0, 0, 0, 0
        docs_here: list[tuple[int | None, int, int]] = []
        head = 0  # ids of the chunk to come that belong to a document begun before it

        def emit(size: int) -> pa.RecordBatch:
            nonlocal first, chunk, ordinal, docs_here, head
            ids = np.frombuffer(bytes(waiting[:4 * size]), "<u4")
            del waiting[:4 * size]
            row = {"shard": shard, "chunk": chunk, "first": first, "n_ids": size, "head": min(head, size), "ordinal": ordinal,
                   "doc_ids": [d[0] for d in docs_here], "begins": [d[1] for d in docs_here],
                   "lengths": [d[2] for d in docs_here], "width": width, "planes": to_planes(ids, width)}
            first, chunk, ordinal = first + size, chunk + 1, ordinal + len(docs_here)
            head = max(0, (docs_here[-1][1] + docs_here[-1][2] - first) if docs_here else head - size)
            docs_here = []
            return pa.RecordBatch.from_pylist([row], _ARROW)

        for batch in batches:
            texts = (text.as_py() for text in batch.column(1))  # they become Python strings one at a time
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts)):
                ids += end
                docs_here.append((doc_id, total, len(ids) // 4))
                total += len(ids) // 4
                waiting += ids
                while len(waiting) >= 4 * chunk_ids:
                    yield emit(chunk_ids)
        if waiting:
            yield emit(len(waiting) // 4)

    ordered = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).orderBy(
        F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.monotonically_increasing_id())
    with arrow_rows(docs.sparkSession, TEXT_ROWS):
        ordered.mapInArrow(run, SCHEMA).write.option("compression", "uncompressed").parquet(path)


def _times(matrix: list[int], vector: int) -> int:
    out, row = 0, 0
    while vector:
        if vector & 1:
            out ^= matrix[row]
        vector >>= 1
        row += 1
    return out


def crc32_join(first: int, second: int, length: int) -> int:
    """The CRC-32 of two byte strings joined, from those of each and the length of the second.

    Appending a zero byte is a linear map of the register; it is raised to the length by squaring.
    """
    step = [0xEDB88320] + [1 << bit for bit in range(31)]  # one zero bit
    for _ in range(3):
        step = [_times(step, column) for column in step]  # one zero byte
    while length:
        if length & 1:
            first = _times(step, first)
        step = [_times(step, column) for column in step]
        length >>= 1
    return first ^ second


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in (batch.slice(at, 1).to_pylist()[0] for at in range(batch.num_rows)):
            ids = from_planes(row["planes"], row["n_ids"], row["width"])
            out = []
            if row["head"]:
                own = ids[:row["head"]]
                out.append((row["shard"], row["ordinal"] - 1, None, None, None, row["chunk"], zlib.crc32(own.tobytes()), len(own)))
            for at, (doc_id, begin, length) in enumerate(zip(row["doc_ids"], row["begins"], row["lengths"])):
                own = ids[begin - row["first"]:begin - row["first"] + length]
                out.append((row["shard"], row["ordinal"] + at, doc_id, begin, length, row["chunk"], zlib.crc32(own.tobytes()), len(own)))
            kinds = [pa.int32()] + [pa.int64()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                ["shard", "ordinal", "doc_id", "begin", "n_tokens", "chunk", "crc", "size"])


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files under ``path``: ``doc_id, start, n_tokens, ids_crc32``, from its decoded ids.

    Chunks are decoded apart from each other; the checksums of a document that
    spans chunks are joined from those of its parts.
    """
    chunks = spark.read.schema(SCHEMA).parquet(path)

    @F.udf("bigint")
    def joined(parts):
        if parts is None:
            return None
        crc = parts[0]["crc"]
        for part in parts[1:]:
            crc = crc32_join(crc, part["crc"], 4 * part["size"])
        return crc

    parts = chunks.mapInArrow(
        _pieces, "shard int, ordinal bigint, doc_id bigint, begin bigint, n_tokens bigint, chunk bigint, crc bigint, size bigint")
    whole = parts.groupBy("shard", "ordinal").agg(
        F.max("doc_id").alias("doc_id"), F.max("begin").alias("begin"), F.max("n_tokens").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("chunk", "crc", "size"))).alias("_parts"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per task that wrote
    shards = chunks.groupBy("shard").agg(F.sum("n_ids").alias("_ids")).select(
        "shard", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_before"))
    several = joined(F.when(F.size("_parts") > 1, F.col("_parts")))  # a function of Python sees every row, so the others are null
    crc = F.coalesce(several, F.col("_parts")[0]["crc"])
    return whole.join(shards, "shard").select(
        "doc_id", (F.col("_before") + F.col("begin")).alias("start"), "n_tokens", crc.alias("ids_crc32"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The stored ids, one row per chunk: ``shard, chunk, first, ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(at, 1).to_pylist()[0] for at in range(batch.num_rows)):
                ids = from_planes(row["planes"], row["n_ids"], row["width"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"]], pa.int32()), pa.array([row["chunk"]], pa.int64()),
                     pa.array([row["first"]], pa.int64()), pa.array([ids.astype(np.int64)], pa.list_(pa.int64()))],
                    ["shard", "chunk", "first", "ids"])

    return spark.read.schema(SCHEMA).parquet(path).mapInArrow(run, "shard int, chunk bigint, first bigint, ids array<bigint>")
