"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents its predecessor kept, as written Parquet, and all
but the last return the columns of ``documents``. What a stage writes besides its
result is dropped when the next one begins.

Null texts are empty documents: the classifier judges them like any other, and all
of them are near copies of one another, so at most one stays. Texts of any length
are processed whole. Repeated rows count each until the near-copy stage, which keeps
one of them; of equal ids the first position stays, null ids come last. An empty
table passes all stages as one. After the last stage the session keeps handing Python ``TEXT_ROWS`` rows at a time,
as that stage's result is computed by its reader.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm import cotraining, mixing, packing, pii, simhash
from starfold.llm.base import TEXT_ROWS
from starfold.llm.queries import vocabulary
from starfold.session import drop_scratch, scratch_scope, set_arrow_rows, written
from starfold.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject, each row for itself; all of them when no label is usable."""
    return cotraining.accepted(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash fingerprints of four-word shingles link at 4 bits or fewer, the one of the least id."""
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data and terms that disclose it hidden; ``n_chars`` follows the text."""
    clean = pii.sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them; null sources are one source."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens, with their token ids (``ids``, four bytes each)."""
    # fewer words than op9 remembers: what the stages before have left in the executors' memory is still there
    return packing.pack_documents(docs, vocabulary(), with_ids=True, remembered=40_000)


def _apart(work: Callable[..., DataFrame], rows: int | None, spark: SparkSession, docs: DataFrame, sf_dir: str, scope: str = "pipeline") -> DataFrame:
    """Run a stage with scratch of its own, dropping that of the stage before: its result is written by now.

    ``rows`` are those that the stage's result, which is computed by whoever writes it, hands Python at a time.
    """
    drop_scratch(spark, scope)
    set_arrow_rows(spark, rows)
    with scratch_scope(scope):
        return work(spark, docs, sf_dir)


STAGES = [(name, partial(_apart, work, rows)) for name, work, rows in (
    ("quality classifier", quality, TEXT_ROWS),
    ("simhash near-dedup", near_duplicates, None),
    ("pii", personal_data, None),
    ("source mixing", source_mix, None),
    ("packing", packed, TEXT_ROWS),
)]

#: The classifier, fingerprint trees and tokenizer have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``; of their results only the last two are held at a time."""
    docs, own = read_table(spark, sf_dir, "documents"), f"pipeline-{uuid.uuid4().hex[:12]}"
    for at, (name, stage) in enumerate(STAGES[:-1]):
        after = stage(spark, docs, sf_dir, scope=f"{own}/stage")
        with scratch_scope(f"{own}/{at}"):
            docs = written(after, name.replace(" ", "-"))
        if at:
            drop_scratch(spark, f"{own}/{at - 1}")
    return STAGES[-1][1](spark, docs, sf_dir, scope=f"{own}/stage")
