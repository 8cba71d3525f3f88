"""Ranked lexical search by an Aho-Corasick scan of the documents, without an index of them.

The items' terms, guarded by a boundary on either side, form one automaton that is
broadcast. A scan of the texts sends every document through it and counts each
term's occurrences straight from the text; boundaries are part of the patterns, so
nothing inside a longer word is reported. Numbers of documents follow from these
counts, then weights, and in a second step the automaton's outputs are mapped to the
items that hold them: every task scores its documents for all items and keeps the
best of each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

TOP = 10
#: Items are searched in blocks of about so many bytes of text, so an automaton and the tables of scores have a bounded size.
BLOCK_BYTES = 4 << 20
BLOCK_ITEMS = 1024
#: Documents that are scored together: their table has so many rows and a column for each item of the block.
DOCUMENTS = 512
_B = 75
_FOUND = "item int, doc_id bigint, score bigint"

#: Bytes of A-Z lower-cased, other ASCII characters but a-z and 0-9 as blanks; all bytes of other characters belong to terms.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _guarded(terms: list[bytes]) -> str:
    """Terms with a blank on either side of each; a character for every byte."""
    return f" {b'  '.join(terms).decode('latin-1')} "


def automaton(terms: list[bytes]):
    """The automaton of guarded terms; what it reports is a term's place in the list."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for at, term in enumerate(terms):
        found.add_word(_guarded([term]), at)
    found.make_automaton()
    return found


def counts(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """``doc_id, n, terms, tf`` per row of ``docs``: how many terms its text has, which of ``terms`` and how often each."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)  # of one block, see BLOCK_BYTES

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(shared.value) if shared.value else None
        for batch in batches:
            n, held, often = [], [], []
            for text in batch.column(1):
                own = _terms(text.as_py())
                n.append(len(own))
                found = np.fromiter((at for _, at in machine.iter(_guarded(own))), np.int32) if own and machine else np.empty(0, np.int32)
                which, tf = np.unique(found, return_counts=True)
                held.append(which), often.append(tf)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(held, pa.list_(pa.int32())), pa.array(often, pa.list_(pa.int64()))],
                ["doc_id", "n", "terms", "tf"])

    text = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return text.mapInArrow(scan, "doc_id bigint, n bigint, terms array<int>, tf array<bigint>")


def _document_frequencies(found: DataFrame, terms: int) -> np.ndarray:
    """In how many documents each term is; tasks count their own and hand on a row for each term met."""

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=terms)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], ["term", "df"])

    out = np.zeros(terms, np.int64)
    for r in found.select("terms").mapInArrow(in_task, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]
    return out


class Outputs:
    """The items that hold each term, with how often: the lists of all terms one after another."""

    def __init__(self, items: list[list[int]], terms: int):
        held = [np.unique(np.array(own, np.int64), return_counts=True) for own in items]
        term = np.concatenate([np.empty(0, np.int64), *[t for t, _ in held]])
        order = np.argsort(term, kind="stable")
        self.items = len(items)
        self.item = np.repeat(np.arange(len(items)), [len(t) for t, _ in held])[order]
        self.times = np.concatenate([np.empty(0, np.int64), *[n for _, n in held]])[order]
        self.begin = np.searchsorted(term[order], np.arange(terms + 1))

    def scores(self, docs: np.ndarray, term: np.ndarray, worth: np.ndarray, rows: int) -> np.ndarray:
        """A row for each of ``rows`` documents and a column for each item: the sum of what the document's terms are worth to it."""
        length = self.begin[term + 1] - self.begin[term]
        at = np.repeat(self.begin[term], length) + np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        out = np.zeros(rows * self.items, np.int64)
        np.add.at(out, np.repeat(docs, length) * self.items + self.item[at], np.repeat(worth, length) * self.times[at])
        return out.reshape(rows, self.items)


def _best(found: DataFrame, outputs: Outputs, weight: np.ndarray, documents: int, length: int, top: int) -> DataFrame:
    """``item, doc_id, score``: of each task's documents the best ``top`` of every item."""

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.empty(0, np.int64) for _ in range(4)]  # item, no id, id, score
        for batch in batches:
            for begin in range(0, batch.num_rows, DOCUMENTS):
                some = batch.slice(begin, DOCUMENTS)
                ids, none = some.column(0).fill_null(0).to_numpy(), some.column(0).is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                sizes = np.diff(some.column(2).offsets.to_numpy())
                doc, term, tf = np.repeat(np.arange(len(ids)), sizes), some.column(2).flatten().to_numpy(), some.column(3).flatten().to_numpy()
                m = 100 - _B + (_B * some.column(1).to_numpy() * documents) // length
                worth = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
                scores = outputs.scores(doc, term, worth, len(ids))
                at, item = np.nonzero(scores)
                best = [np.concatenate(x) for x in zip(best, (item, none[at], ids[at], scores[at, item]))]
                order = np.lexsort((best[2], best[1], -best[3], best[0]))
                own = best[0][order]
                order = order[np.arange(len(own)) - np.searchsorted(own, own) < top]
                best = [x[order] for x in best]
        yield pa.RecordBatch.from_arrays(
            [pa.array(best[0].astype(np.int32)), pa.array(best[2], mask=best[1] > 0), pa.array(best[3])], ["item", "doc_id", "score"])

    return found.mapInArrow(in_task, _FOUND)


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item by score, best first, equal scores by ascending id.

    ``docs`` needs ``doc_id`` and ``text``, ``items`` ``item_id`` and ``text``; other
    columns are ignored. Null texts have no terms. Every row of ``docs`` is a
    document and every row of ``items`` an item, repeated ids and texts included;
    documents without an id come after others of their score. Documents of score 0
    are not returned, so an item without terms, or an empty table, gives no rows.
    Items are the query set: they are dealt into blocks of bounded size by their
    position, and each block scans the documents once.
    """
    spark = docs.sparkSession
    numbered = written(items.select(
        F.monotonically_increasing_id().alias("_row"), F.col("item_id").cast("bigint").alias("item_id"),
        F.col("text").cast("string").alias("text")), "lexical-items")
    size = numbered.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    blocks = max(-(-size["n"] // BLOCK_ITEMS), -(-(size["b"] or 0) // BLOCK_BYTES))
    found = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for block in range(blocks):
        found = found.union(_search_block(docs, numbered.where(F.pmod(F.xxhash64("_row"), F.lit(blocks)) == block), top))
    return found


def _search_block(docs: DataFrame, items: DataFrame, top: int) -> DataFrame:
    spark = docs.sparkSession
    rows = items.select("_row", "item_id", "text").orderBy("_row").collect()  # one block
    place: dict[bytes, int] = {}
    held = [[place.setdefault(term, len(place)) for term in _terms(r["text"])] for r in rows]
    counted = written(counts(docs, list(place)), "lexical-counts")
    total = counted.where("n > 0").agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("length")).first()
    met = counted.where(F.size("terms") > 0)
    frequency = _document_frequencies(met, len(place))
    weight = np.array([math.floor(1000 * math.log((2 * total["documents"] + 2) / (2 * df + 1))) for df in frequency.tolist()], np.int64)
    best = _best(met, Outputs(held, len(place)), weight, total["documents"], total["length"] or 1, top)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = spark.createDataFrame([(at, r["item_id"]) for at, r in enumerate(rows)], "item int, item_id bigint")
    return ranked.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
