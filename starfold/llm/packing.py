"""Hierarchical multi-length packing of token ids into training sequences.

Documents are routed to context-size tiers (2048, 1024, 512, 256 by default) by
what is left of them after whole windows. Each tier is packed from the longest
down: a window opens with a document of its own tier and its gap is filled with
whole documents of shorter tiers, the longest that fit first; what no whole
document fills, a cut piece does. Windows of a tier are exactly full, so none of
them needs padding; the end of a group is cut into power-of-two windows. Windows
are then dealt to step groups of equal tokens, longest first to the emptiest.

Packing needs no shuffle: each task packs the documents of its own partition in
groups of bounded size, so a hot source or very long documents do not matter.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import TokenIds, shared

TIERS = (2048, 1024, 512, 256)
END_ID = 1
#: A group is packed when it holds so many documents or tokens.
GROUP_DOCUMENTS = 4096
GROUP_TOKENS = 4_000_000
STEP_TOKENS = 64 * 2048

Piece = tuple[int, int, int]  # document, start in it, length


class _Remainders:
    """What is left of documents, by tier and length; pieces are taken from their front."""

    def __init__(self, tiers: Sequence[int]):
        self._tiers = tuple(sorted(tiers, reverse=True))
        self._by_tier: dict[int, list[tuple[int, int, int]]] = {t: [] for t in self._tiers}  # (length, document, start)

    def add(self, length: int, document: int, start: int) -> None:
        if length:
            tier = min(t for t in self._tiers if t >= length)
            insort(self._by_tier[tier], (length, document, start))

    def open(self, tier: int) -> tuple[int, int, int] | None:
        """The longest remainder of the tier itself."""
        own = self._by_tier[tier]
        return own.pop() if own else None

    def fitting(self, gap: int) -> tuple[int, int, int] | None:
        """The longest remainder of at most ``gap`` tokens."""
        for tier in self._tiers:
            own = self._by_tier[tier]
            at = bisect_right(own, (gap + 1,))
            if at:
                return own.pop(at - 1)
        return None

    def shortest(self) -> tuple[int, int, int] | None:
        for tier in reversed(self._tiers):
            if self._by_tier[tier]:
                return self._by_tier[tier].pop(0)
        return None


def pack(lengths: Sequence[int], tiers: Sequence[int] = TIERS) -> list[list[Piece]]:
    """Windows of pieces that hold every token of the documents once, each as long as a tier or a power of two."""
    tiers = sorted(tiers, reverse=True)
    longest = tiers[0]
    windows: list[list[Piece]] = []
    left = _Remainders(tiers)
    for document, length in enumerate(lengths):
        whole = length - length % longest
        windows += [[(document, start, longest)] for start in range(0, whole, longest)]
        left.add(length - whole, document, whole)

    for tier in tiers:
        while (opened := left.open(tier)) is not None:
            length, document, start = opened
            window, gap = [(document, start, length)], tier - length
            while gap and (more := left.fitting(gap)) is not None:
                length, document, start = more
                window.append((document, start, length))
                gap -= length
            if gap and (cut := left.shortest()) is not None:
                length, document, start = cut
                window.append((document, start, gap))
                left.add(length - gap, document, start + gap)
                gap = 0
            windows += [window] if not gap else _powers(window)
    return windows


def _powers(pieces: list[Piece]) -> list[list[Piece]]:
    """The last, unfilled window as windows of falling powers of two."""
    total = sum(length for _, _, length in pieces)
    sizes = [1 << bit for bit in range(total.bit_length() - 1, -1, -1) if total >> bit & 1]
    windows, queue = [], list(reversed(pieces))
    for size in sizes:
        window: list[Piece] = []
        while size:
            document, start, length = queue.pop()
            taken = min(size, length)
            window.append((document, start, taken))
            size -= taken
            if taken < length:
                queue.append((document, start + taken, length - taken))
        windows.append(window)
    return windows


def balance(sizes: Sequence[int], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A step for each window such that steps hold about equally many tokens."""
    steps = max(1, round(sum(sizes) / step_tokens))
    loads = [(0, step) for step in range(steps)]
    chosen = [0] * len(sizes)
    for window in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        load, step = heapq.heappop(loads)
        chosen[window] = step
        heapq.heappush(loads, (load + sizes[window], step))
    return chosen


SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint, tier int, step_id bigint")


def pack_documents(docs: DataFrame, tokenizer: str, tiers: Sequence[int] = TIERS, end_id: int = END_ID,
                   with_ids: bool = False, remembered: int | None = None) -> DataFrame:
    """One row per piece of a document in a sequence (``SCHEMA``), with the piece's ids as ``ids`` if asked for.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Each row is
    a document of its own, also with a null or repeated ``doc_id``. A null or
    empty text is its end id alone. An empty table gives no rows. ``sequence_id``
    and ``step_id`` carry the partition, so they are unique and a retried task
    repeats them. ``remembered`` bounds the words
    a task remembers, at the price of encoding some again; else those of a worker's tasks are shared.
    """
    schema = SCHEMA + (", ids binary" if with_ids else "")
    names = [field.split()[0] for field in schema.split(", ")]
    kinds = {"tier": pa.int32(), "ids": pa.binary()}
    end = end_id.to_bytes(4, "little")

    def emit(group: list[tuple[int | None, bytes]], base: int, step_base: int) -> tuple[pa.RecordBatch, int, int]:
        windows = pack([len(ids) // 4 for _, ids in group], tiers)
        sizes = [sum(piece[2] for piece in window) for window in windows]
        steps = balance(sizes)
        columns: list[list] = [[] for _ in names]
        for number, (window, size, step) in enumerate(zip(windows, sizes, steps)):
            offset = 0
            for document, start, length in window:
                doc_id, ids = group[document]
                own = ids[4 * start:4 * (start + length)]
                row = (doc_id, start, length, zlib.crc32(own), len(ids) // 4, base + number, offset, size, step_base + step, own)
                for column, value in zip(columns, row):
                    column.append(value)
                offset += length
        batch = pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.int64())) for n, c in zip(names, columns)], names)
        return batch, base + len(windows), step_base + max(steps, default=-1) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared(tokenizer) if remembered is None else TokenIds(tokenizer, remembered)  # the latter goes with the task
        base = step = TaskContext.get().partitionId() << 40
        group: list[tuple[int | None, bytes]] = []
        tokens = 0
        for batch in batches:
            texts = (text.as_py() for text in batch.column(1))  # they become Python strings one at a time
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts)):
                ids += end
                group.append((doc_id, ids))
                tokens += len(ids) // 4
                if len(group) >= GROUP_DOCUMENTS or tokens >= GROUP_TOKENS:
                    out, base, step = emit(group, base, step)
                    group, tokens = [], 0
                    yield out
        if group:
            yield emit(group, base, step)[0]

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, schema)
