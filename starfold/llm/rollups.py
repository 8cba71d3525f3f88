"""Delta-maintained token counts by source, language and tokenizer version.

A batch of signed changes (inserted documents count up, deleted ones down, revised
counts down under the old and up under the new version) is summed to one small
delta, written, and committed under the batch's name. A batch that is committed
already changes nothing, so a job may be run again after any failure; a delta
without its commit is never read. Totals are the sum of the committed deltas, and
compaction replaces many deltas by their sum.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import WORD
from .tokens import shared

KEYS = ("source", "lang", "tokenizer_version")
SCHEMA = "source string, lang string, tokenizer_version string, docs bigint, tokens decimal(38,0)"

#: Tokenizer versions that one pattern defines. Others are files of the ``tokenizers`` library.
PATTERNS = {
    "words-1": WORD,
    "pieces-1": "[\\p{L}\\p{N}]+|[^\\x09-\\x0D\\x20\\p{L}\\p{N}]",
    "pieces-2": "\\p{L}+|\\p{N}|[^\\x09-\\x0D\\x20\\p{L}\\p{N}]",
}


def token_count(text: Column, version: str) -> Column:
    """Tokens of a text under a tokenizer version: a name in ``PATTERNS`` or the path of a vocabulary file; 0 for null."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    if version in PATTERNS:
        return F.regexp_count(text, F.lit(PATTERNS[version])).cast("bigint")

    @F.arrow_udf("bigint")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = shared(version)
        for batch in batches:
            yield pa.array([len(ids) // 4 for ids in encoder.encode(t.as_py() for t in batch)], pa.int64())

    return counted(text)


def changes(docs: DataFrame, version: str, sign: int, tokens: Column | None = None) -> DataFrame:
    """Each row of ``docs`` as a change: ``sign`` 1 inserts it, -1 deletes it. ``tokens`` are counted unless given."""
    counted = token_count(F.col("text"), version) if tokens is None else tokens.cast("bigint")
    return docs.select(
        F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
        F.lit(version).alias("tokenizer_version"), F.lit(sign).cast("bigint").alias("docs"), (counted * sign).alias("tokens"))


def revised(docs: DataFrame, old: str, new: str, old_tokens: Column | None = None, new_tokens: Column | None = None) -> DataFrame:
    """Documents whose counts move from one tokenizer version to another."""
    return changes(docs, old, -1, old_tokens).union(changes(docs, new, 1, new_tokens))


class Rollup:
    """The store under ``path``: deltas, and one commit file per batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _file(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hadoop

    def commits(self) -> dict[str, dict]:
        """Batch -> its delta's folder and the batches it covers; one small file per batch since the last compaction."""
        fs, folder = self._file(f"{self.path}/commits")
        if not fs.exists(folder):
            return {}
        rows = self.spark.read.text(f"{self.path}/commits", wholetext=True).collect()
        found = [json.loads(r.value) for r in rows]
        return {c["batch"]: c for c in found}

    def _covered(self, commits: dict[str, dict]) -> set[str]:
        return {batch for c in commits.values() for batch in c["covers"]}

    def commit(self, batch: str, delta: DataFrame, covers: list[str] | None = None) -> bool:
        """Add the summed changes of ``delta`` as ``batch``; False, and nothing is computed, if it is there already.

        Null keys form groups of their own. A batch without changes is committed too.
        """
        commits = self.commits()
        if batch in commits or batch in self._covered(commits):
            return False
        summed = delta.groupBy(*KEYS).agg(F.sum("docs").cast("bigint").alias("docs"), F.sum("tokens").cast("decimal(38,0)").alias("tokens"))
        folder = f"deltas/{uuid.uuid4().hex}"
        summed.write.parquet(f"{self.path}/{folder}")
        # a reader sees the commit whole or not at all; of two writers of a batch one remains, and both say the same
        name = uuid.uuid5(uuid.NAMESPACE_URL, batch).hex
        fs, temporary = self._file(f"{self.path}/pending/{name}-{uuid.uuid4().hex}")
        stream = fs.create(temporary, True)
        stream.write(json.dumps({"batch": batch, "folder": folder, "covers": covers or []}).encode())
        stream.close()
        _, final = self._file(f"{self.path}/commits/{name}")
        fs.mkdirs(final.getParent())
        return bool(fs.rename(temporary, final))

    def _deltas(self) -> tuple[list[str], DataFrame]:
        commits = self.commits()
        covered = self._covered(commits)
        live = {batch: c for batch, c in commits.items() if batch not in covered}
        # A compaction covers all that was committed when it read, so of several at a time one covers what the others do.
        whole = max((c for c in live.values() if c["covers"]), key=lambda c: (len(c["covers"]), c["batch"]), default=None)
        live = {batch: c for batch, c in live.items() if not c["covers"] or c is whole}
        reader = self.spark.read.schema(SCHEMA)
        if not live:
            return [], self.spark.createDataFrame([], SCHEMA)
        return sorted(commits), reader.parquet(*sorted(f"{self.path}/{c['folder']}" for c in live.values()))

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer_version, docs, tokens``; groups whose documents are all gone are left out."""
        _, deltas = self._deltas()
        return deltas.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").cast("decimal(38,0)").alias("tokens")).where(
            "docs != 0 or tokens != 0")

    def compact(self) -> bool:
        """Replace the committed deltas by their sum; their batches stay known.

        It is named by what it covers: two that have read the same are one, and of two
        that have not, only the one that covers more counts.
        """
        batches, deltas = self._deltas()
        return bool(batches) and self.commit(f"compaction {uuid.uuid5(uuid.NAMESPACE_URL, json.dumps(batches)).hex}", deltas, batches)
