"""Quality classifier by co-training of two views.

One classifier sees the text's content (its words, their shapes and endings), the
other only page metadata (source, language, length, layout and shares of character
classes). Each is fitted on the labelled rows; then, over rounds, each passes the
unlabelled rows it is surest of on to the other as pseudo-labels. At the end both
are calibrated on labelled rows that none was fitted on, their log-odds are
combined, and all documents are scored.

Texts are read once: what either view sees of a document is written as counts of
hashed features. In each round all unlabelled documents are scored from these on
Spark, and of each view and label the surest distinct texts come to the driver. So
fitting works on at most ``LABELLED`` labelled rows, the least by hash of their id, and
``ROUNDS`` times 2 x ``PASSED_ON`` pseudo-labelled ones; choosing them works on everything.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import arrow_rows, written
from .base import TEXT_ROWS

#: Most labelled rows a fit uses.
LABELLED = 3000
#: Every so manieth labelled row is held out for calibration.
HELD_OUT = 5
ROUNDS, PASSED_ON, SURE = 3, 200, 0.95
BUCKETS = 1 << 15
#: Rows whose features a task unpacks at a time.
TOGETHER = 256
REJECT_BELOW = 0.5
SEED = "quality-1"

_REPEATED = re.compile(r"(.)\1+")
_SHAPE = str.maketrans({chr(c): "A" if c < 91 else "a" for c in (*range(65, 91), *range(97, 123))} | {str(d): "0" for d in range(10)})
_REMEMBERED = 200_000


class TextView:
    """The share of each hashed feature among those of a text's words: the word, its shape and its ending.

    As shares are linear in the words, a fitted view scores a text by the mean of
    one remembered number per word.
    """

    size = BUCKETS
    _scale = 20.0

    def __init__(self, weights: np.ndarray | None = None) -> None:
        self._weights = weights
        self._known: dict[str, float] = {}
        self._numbers: dict[str, int] = {}
        self._rows: np.ndarray | None = None

    def _slots(self, word: str) -> tuple[int, ...]:
        shape = _REPEATED.sub(r"\1", word.translate(_SHAPE))
        features = ("w" + word.lower(), "s" + shape, "t" + word[-3:])
        return tuple(zlib.crc32(f.encode("utf-8", "surrogatepass")) % BUCKETS for f in features)

    def _recall(self, words: list[str]) -> list[float]:
        known = self._known
        for word in set(words).difference(known):
            slots = self._slots(word)
            known[word] = sum(float(self._weights[s]) for s in slots) / len(slots)
        found = [known[word] for word in words]
        if len(known) > _REMEMBERED:
            known.clear()
        return found

    def counted(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The slots of a text's features and how often each occurs."""
        words = text.split()
        if self._rows is None or len(self._numbers) > _REMEMBERED:
            self._numbers, self._rows = {}, np.empty((1 << 16, 3), np.int32)
        numbers = self._numbers
        for word in set(words).difference(numbers):
            if len(numbers) == len(self._rows):
                self._rows = np.concatenate([self._rows, np.empty_like(self._rows)])
            self._rows[len(numbers)] = self._slots(word)
            numbers[word] = len(numbers)
        found = self._rows[np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))]
        return np.unique(found, return_counts=True)

    @classmethod
    def shares(cls, slots: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(slots):
            return np.array([0]), np.array([0.0])
        return slots, cls._scale * counts / counts.sum()

    def __call__(self, text: str, source: str | None, lang: str | None) -> tuple[np.ndarray, np.ndarray]:
        return self.shares(*self.counted(text))

    def odds(self, text: str, source: str | None, lang: str | None) -> float:
        """What the fitted weights say of a text."""
        found = self._recall(text.split())
        return self._scale * sum(found) / max(1, len(found)) + float(self._weights[-1])


class MetadataView:
    """What is known of a document without its words."""

    _names, _value = 512, 1 / 3
    size = _names + 96

    def __init__(self, weights: np.ndarray | None = None) -> None:
        self._weights = weights

    def odds(self, text: str, source: str | None, lang: str | None) -> float:
        slots, values = self(text, source, lang)
        return float(self._weights[slots] @ values) + float(self._weights[-1])

    def __call__(self, text: str, source: str | None, lang: str | None) -> tuple[np.ndarray, np.ndarray]:
        chars = max(1, len(text))
        seen = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
        upper, lower, digits = int(seen[65:91].sum()), int(seen[97:123].sum()), int(seen[48:58].sum())
        blanks, lines = int(seen[32] + seen[9:14].sum()), int(seen[10])
        other = int(seen[:128].sum()) - upper - lower - digits - blanks
        distinct = len(set(text.split())) / max(1, blanks + 1)
        shares = (upper / chars, digits / chars, blanks / chars, lines / max(1, blanks), other / chars, distinct, math.log10(chars) / 6)
        slots = [zlib.crc32(f"l{lang}".encode()) % self._names, zlib.crc32(f"p{source}".encode()) % self._names]
        slots += [self._names + 12 * at + min(11, int(12 * math.sqrt(min(1.0, share)))) for at, share in enumerate(shares)]
        return np.array(slots), np.full(len(slots), self._value)


@dataclass
class Rows:
    """Sparse rows of one view."""

    slots: np.ndarray
    values: np.ndarray
    begins: np.ndarray
    row_of: np.ndarray

    @classmethod
    def of(cls, parts: list[tuple[np.ndarray, np.ndarray]]) -> Rows:
        lengths = np.array([len(s) for s, _ in parts], np.int64)
        return cls(np.concatenate([s for s, _ in parts]), np.concatenate([v for _, v in parts]),
                   np.concatenate(([0], np.cumsum(lengths)[:-1])), np.repeat(np.arange(len(parts)), lengths))

    def odds(self, weights: np.ndarray) -> np.ndarray:
        return np.add.reduceat(weights[self.slots] * self.values, self.begins) + weights[-1]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_view(rows: Rows, size: int, labels: np.ndarray, importance: np.ndarray, steps: int = 150, decay: float = 1e-5) -> np.ndarray:
    """Logistic regression by accelerated full-batch steps; classes weigh alike; the last weight is the constant."""
    for label in (0, 1):
        own = labels == label
        if importance[own].sum() > 0:
            importance = np.where(own, importance * (0.5 / importance[own].sum()), importance)
    # the loss curves at most a quarter of the mean squared length of a row, with 1 for the constant
    rate = 4 / (float((np.add.reduceat(rows.values**2, rows.begins) * importance).sum()) + 1 + decay)
    used = importance[rows.row_of] > 0
    slots, values, row_of = rows.slots[used], rows.values[used], rows.row_of[used]
    weights, ahead, pace = np.zeros(size + 1), np.zeros(size + 1), 1.0
    for _ in range(steps):
        odds = np.bincount(row_of, ahead[slots] * values, len(labels)) + ahead[-1]
        error = (_sigmoid(odds) - labels) * importance
        gradient = np.bincount(slots, values * error[row_of], size + 1) + decay * ahead
        gradient[-1] = error.sum()
        fresh = ahead - rate * gradient
        further = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        ahead, weights, pace = fresh + (pace - 1) / further * (fresh - weights), fresh, further
    return weights


def calibrate(odds: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and constant that turn odds of held-out rows into log-odds (Platt scaling with smoothed targets, over standardised odds)."""
    n = np.bincount(labels, minlength=2)
    target = np.where(labels == 1, (n[1] + 1) / (n[1] + 2), 1 / (n[0] + 2))
    spread = float(odds.std()) or 1.0
    odds = odds / spread
    slope, constant = 1.0, 0.0
    for _ in range(50):  # Newton steps on two parameters
        p = _sigmoid(slope * odds + constant)
        w = np.maximum(p * (1 - p), 1e-6)
        g = np.array([((p - target) * odds).sum() + 1e-2 * slope, (p - target).sum()])
        h = np.array([[(w * odds * odds).sum() + 1e-2, (w * odds).sum()], [(w * odds).sum(), w.sum() + 1e-6]])
        change = np.linalg.solve(h, g)
        slope, constant = slope - change[0], constant - change[1]
        if abs(change).max() < 1e-8:
            break
    return max(0.0, float(slope)) / spread, float(constant)


@dataclass
class Model:
    """Two fitted views, their calibration, and the share of good rows among the labelled."""

    weights: tuple[np.ndarray, np.ndarray]
    scaling: tuple[tuple[float, float], tuple[float, float]]
    prior: float
    passed_on: int = 0

    def combine(self, odds: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probabilities by text, by metadata, and of both: their log-odds add up and the prior counts once."""
        text, metadata = (slope * o + constant for o, (slope, constant) in zip(odds, self.scaling))
        return _sigmoid(text), _sigmoid(metadata), _sigmoid(text + metadata - self.prior)


def _from_text(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    count = len(blob) // 6
    return TextView.shares(np.frombuffer(blob, "<u2", count).astype(np.int64), np.frombuffer(blob, "<u4", count, 2 * count).astype(np.int64))


def _from_metadata(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    slots = np.frombuffer(blob, "<u2").astype(np.int64)
    return slots, np.full(len(slots), MetadataView._value)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of ``TOGETHER`` rows, as their features are unpacked into wide numbers."""
    for batch in batches:
        for at in range(0, batch.num_rows, TOGETHER):
            yield batch.slice(at, TOGETHER)


def _rows_of(texts, metadata) -> tuple[Rows, Rows]:
    """The rows of both views from what :func:`features` has written."""
    return Rows.of([_from_text(blob) for blob in texts]), Rows.of([_from_metadata(blob) for blob in metadata])


@dataclass
class Passed:
    """A document that a view is sure of: its features, to be seen by the other view under ``label``."""

    view: int
    label: int
    same: int
    text: bytes
    metadata: bytes


def co_train(known: list[tuple[bytes, bytes]], labels: np.ndarray, surest: Callable[[tuple[np.ndarray, np.ndarray], list[Passed]], list[Passed]],
             rounds: int = ROUNDS) -> Model:
    """Fit both views on the features of labelled rows and, round by round, on what ``surest`` finds under the weights so far."""
    held = np.arange(len(known)) % HELD_OUT == HELD_OUT - 1
    passed: list[Passed] = []

    def fitted() -> tuple[np.ndarray, np.ndarray]:
        weights = []
        for at, view in enumerate((TextView, MetadataView)):
            own = [p for p in passed if p.view != at]
            rows = _rows_of([t for t, _ in known] + [p.text for p in own], [m for _, m in known] + [p.metadata for p in own])[at]
            importance = np.concatenate([np.where(held, 0.0, 1.0), np.full(len(own), 0.5)])
            weights.append(fit_view(rows, view.size, np.concatenate([labels, [p.label for p in own]]).astype(int), importance))
        return weights[0], weights[1]

    weights = fitted()
    for _ in range(rounds):
        more = surest(weights, passed)
        if not more:
            break
        passed += more
        weights = fitted()
    both = _rows_of([t for t, _ in known], [m for _, m in known])
    truth = labels[held].astype(int)
    scaling = tuple(calibrate(both[at].odds(weights[at])[held], truth) for at in (0, 1))
    good = min(max(float(labels.mean()), 1e-3), 1 - 1e-3)
    return Model(weights, scaling, math.log(good / (1 - good)), len(passed))


def _text_rows(docs: DataFrame) -> DataFrame:
    have = {c.lower() for c in docs.columns}
    optional = [F.col(c).cast("string").alias(c) if c in have else F.lit(None).cast("string").alias(c) for c in ("source", "lang")]
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *optional)


def features(docs: DataFrame) -> DataFrame:
    """``_row, doc_id, same, text, metadata`` per row of ``docs``: a hash of the text, and what either view sees, as counts of slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        views = TextView(), MetadataView()
        for batch in batches:
            same, of_text, of_metadata = [], [], []
            for text, source, lang in zip(batch.column(2), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                text = text.as_py()
                same.append(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 42) - (1 << 63))
                slots, counts = views[0].counted(text)
                of_text.append(slots.astype("<u2").tobytes() + counts.astype("<u4").tobytes())
                of_metadata.append(views[1](text, source, lang)[0].astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(same, pa.int64()), pa.array(of_text, pa.binary()), pa.array(of_metadata, pa.binary())],
                ["_row", "doc_id", "same", "text", "metadata"])

    rows = _text_rows(docs).select(F.monotonically_increasing_id().alias("_row"), "doc_id", "text", "source", "lang")
    return rows.mapInArrow(run, "_row bigint, doc_id bigint, same bigint, text binary, metadata binary")


def prepare(docs: DataFrame, labels: DataFrame, most_labelled: int = LABELLED) -> DataFrame:
    """The features of all ``docs``, written, with ``quality``: 0 or 1 for the labelled documents a fit uses, -1 for all others.

    Labels that are null or neither 0 nor 1 are left out; a document with labels of
    both kinds counts by the smaller. Which of more labels are used goes by a hash of
    the id, so reruns agree.
    """
    told = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.min(F.col("quality").cast("int")).alias("quality"))
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id is not null")
    chosen = told.join(ids, "doc_id", "left_semi").orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(most_labelled)
    seen = features(docs).join(F.broadcast(chosen), "doc_id", "left")  # at most most_labelled rows
    with arrow_rows(docs.sparkSession, TEXT_ROWS):
        return written(seen.select("_row", "doc_id", "same", "text", "metadata", F.coalesce("quality", F.lit(-1)).alias("quality")), "views")


def surest(rows: DataFrame, weights: tuple[np.ndarray, np.ndarray], most: tuple[int, int], sure: float, left_out: tuple[set[int], set[int]]) -> list[Passed]:
    """For each view and label the unlabelled texts it is surest of: at most ``most[label]`` distinct ones, of a probability of ``sure`` or more.

    All rows are scored; a task hands on its own best ones. ``left_out`` holds the
    hashes of texts that a view may not pass on. Equal probabilities go by the text's hash.
    """

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], dict[int, tuple]] = {(v, label): {} for v in (0, 1) for label in (0, 1)}
        least = dict.fromkeys(best, 0.0)  # what a full list asks for
        by_rank = lambda held: sorted(held.items(), key=lambda item: (-item[1][0], item[0]))
        for batch in _slices(batches):
            same, texts, metadata = batch.column(0).to_numpy(), batch.column(1), batch.column(2)
            for view, own in enumerate(_rows_of(texts.to_pylist(), metadata.to_pylist())):
                p = _sigmoid(own.odds(weights[view]))
                for label, confidence in ((1, p), (0, 1 - p)):
                    held = best[view, label]
                    at = np.flatnonzero(confidence >= sure)
                    for i in at[np.lexsort((same[at], -confidence[at]))].tolist():
                        text = int(same[i])
                        if confidence[i] < least[view, label]:
                            break
                        if text not in left_out[view] and (text not in held or held[text][0] < confidence[i]):
                            held[text] = (float(confidence[i]), texts[i].as_py(), metadata[i].as_py())
                    if len(held) > most[label]:
                        best[view, label] = dict(by_rank(held)[:most[label]])
                        least[view, label] = min(item[0] for item in best[view, label].values())
        out = [(v, label, same, *item) for (v, label), held in best.items() for same, item in by_rank(held)]
        columns = list(zip(*out)) or [[]] * 6
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], ["view", "label", "same", "confidence", "text", "metadata"])

    found = rows.where("quality < 0").select("same", "text", "metadata").mapInArrow(
        in_task, "view int, label int, same bigint, confidence double, text binary, metadata binary")
    first = Window.partitionBy("view", "label", "same").orderBy(F.desc("confidence"), "metadata")
    order = Window.partitionBy("view", "label").orderBy(F.desc("confidence"), "same")
    distinct = found.withColumn("_n", F.row_number().over(first)).where("_n = 1")
    kept = distinct.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= F.when(F.col("label") == 1, most[1]).otherwise(most[0]))
    with arrow_rows(rows.sparkSession, TEXT_ROWS):
        best = kept.orderBy("view", "label", "_n").collect()
    return [Passed(r["view"], r["label"], r["same"], r["text"], r["metadata"]) for r in best]


def train_rows(rows: DataFrame, passed_on: int = PASSED_ON, rounds: int = ROUNDS, sure: float = SURE) -> Model | None:
    """A model of what :func:`prepare` has written, or None unless both labels occur often enough to hold some out."""
    one = F.min_by(F.struct("same", "text", "metadata", "quality"), F.struct("same", "_row")).alias("r")
    known = rows.where("quality >= 0").groupBy("doc_id").agg(one).select("r.*", "doc_id").orderBy("doc_id").collect()  # at most LABELLED
    labels = np.array([r["quality"] for r in known], int)
    if len(set(labels.tolist())) < 2 or len(known) < 2 * HELD_OUT:
        return None
    told = {r["same"] for r in known}
    share = float(labels[np.arange(len(labels)) % HELD_OUT != HELD_OUT - 1].mean())
    most = (max(1, round(passed_on * (1 - share))), max(1, round(passed_on * share)))

    def of_all(weights: tuple[np.ndarray, np.ndarray], passed: list[Passed]) -> list[Passed]:
        return surest(rows, weights, most, sure, tuple(told | {p.same for p in passed if p.view == view} for view in (0, 1)))

    return co_train([(r["text"], r["metadata"]) for r in known], labels, of_all, rounds)


def train(docs: DataFrame, labels: DataFrame, most_labelled: int = LABELLED, passed_on: int = PASSED_ON, rounds: int = ROUNDS) -> Model | None:
    """A model of ``labels`` (``doc_id``, ``quality`` 0 or 1) and all ``docs``; see :func:`prepare` and :func:`train_rows`."""
    return train_rows(prepare(docs, labels, most_labelled), passed_on, rounds)


_SCORES = ("text_score", "metadata_score", "score")


def score_rows(rows: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, text_score, metadata_score, score`` of every row of :func:`prepare`, without reading its text again; without a model all are 1."""
    if model is None:
        return rows.select("doc_id", *[F.lit(1.0).alias(n) for n in _SCORES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            own = _rows_of(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            scores = model.combine((own[0].odds(model.weights[0]), own[1].odds(model.weights[1])))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.float64()) for c in scores]], ["doc_id", *_SCORES])

    return rows.select("doc_id", "text", "metadata").mapInArrow(run, "doc_id bigint, text_score double, metadata_score double, score double")


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``text_score``, ``metadata_score`` and ``score``, the probabilities of good quality.

    Rows are scored one by one, so repeated rows are scored alike and an empty table gives no rows. All columns stay, but one that has the name of a score is replaced. A null text is empty; sources and languages that were not
    seen (null among them) only add nothing. Without a model all scores are 1.
    """
    docs = docs.drop(*_SCORES)
    if model is None:
        return docs.select("*", *[F.lit(1.0).alias(n) for n in _SCORES])
    columns = {c.lower(): c for c in docs.columns}
    given = [F.col(f"`{columns[c]}`").cast("string") if c in columns else F.lit(None).cast("string") for c in ("text", "source", "lang")]

    @F.arrow_udf("struct<text_score:double,metadata_score:double,score:double>")
    def scored(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        views = (TextView(model.weights[0]), MetadataView(model.weights[1]))
        for texts, sources, langs in batches:
            parts: list[list[float]] = [[], []]
            for text, source, lang in zip(texts, sources.to_pylist(), langs.to_pylist()):
                text = text.as_py() or ""
                for at, view in enumerate(views):
                    parts[at].append(view.odds(text, source, lang))
            columns = model.combine((np.array(parts[0]), np.array(parts[1])))
            yield pa.StructArray.from_arrays([pa.array(c, pa.float64()) for c in columns], list(_SCORES))

    made = docs.withColumn("_scores", scored(*given))
    return made.select(*[F.col(f"`{c}`") for c in docs.columns], *[F.col(f"_scores.{n}").alias(n) for n in _SCORES])


def accepted(docs: DataFrame, labels: DataFrame, reject_below: float = REJECT_BELOW, **bounds) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with their columns as they are.

    Each row is judged for itself, a null text as an empty one; repeated rows are kept or
    rejected alike. Without usable labels all rows stay, of an empty table none.
    """
    columns = {name: f"_c{at}" for at, name in enumerate(docs.columns)}
    own = docs.toDF(*columns.values())
    named = own.select("*", *[F.col(columns[c]).alias(c) for c in ("doc_id", "text", "source", "lang") if c in columns])
    kept = score(named, train(named, labels, **bounds)).where(F.col("score") >= reject_below)
    return kept.select(*[F.col(c).alias(name) for name, c in columns.items()])
