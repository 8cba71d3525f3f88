"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

A is the fit list, one centred vector a row, over the root of its length. From a
random unit vector v the products A v and Aᵀ u alternate, which builds orthonormal
v's, orthonormal u's and the bidiagonal B = Uᵀ A V; both are orthogonalised against
all their predecessors in each step. The singular values of the small B are the
standard deviations, and V times its right vectors the components.

One job a step makes both products: a task computes its rows' part of u = A p and
at once their part of Aᵀ u, so only the latter, one number a dimension, leaves it.
A u is never stored: it is A w of a w with one number a dimension, which the rows
can turn into u again, and its product with another u = A p is w · (Aᵀ A p).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Entries from this on have no exact place among the integers; they count as not finite.
LIMIT = float(1 << 53) / SCALE
#: Up to so many dimensions B is built whole, which also finds eigenvalues that occur several times; beyond, until the wanted
#: components have converged.
WHOLE = 256
#: Components whose variance is below this part of the largest are rounding noise and not whitened.
NOISE = 1e-11
#: Numbers that all tasks together may hand to the driver in one job (32 MB).
PARTIALS = 1 << 22
_SPLIT = 26


@dataclass
class Whitening:
    """``count`` vectors of the fit list with per-dimension ``sums``, and the components (columns) of their covariance."""

    count: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float = float("nan")

    @property
    def base(self) -> np.ndarray:
        return np.array([s // self.count for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """What the sums hold beyond ``count`` times the base."""
        return np.array([s % self.count for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n; the integer part of the mean goes off exactly before anything is rounded."""
        return (x - self.base) - np.array([float(Fraction(s % self.count, self.count)) for s in self.sums])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def integers(vectors: DataFrame) -> DataFrame:
    """``vec_id, x`` of the vectors that take part: not null, not empty, every entry finite."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LIMIT))
    return rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & finite).select(
        "vec_id", F.transform("v", lambda c: F.floor(c * SCALE) + F.lit(SHIFT)).alias("x"))


def _total(rows: DataFrame, width: int, add: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> list:
    """The sum over all rows of what ``add`` gives for a matrix of them: one vector a task, at most ``PARTIALS`` numbers together."""

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = add(_matrix(batch.column(0)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.int64() if kind == "bigint" else pa.float64()))], ["part"])

    parts = rows.coalesce(max(64, PARTIALS // width)).mapInArrow(in_task, f"part array<{kind}>").toArrow().column("part").to_pylist()
    return [sum(values) for values in zip(*parts)]  # in the order of the tasks, integers without overflow


def bidiagonalise(product: Callable[[np.ndarray], np.ndarray], dimensions: int, wanted: int, trace: float, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors (columns) and singular values of A, by falling value; ``product`` is p -> Aᵀ(A p)."""
    random = np.random.default_rng(seed)
    tiny = 1e-13 * np.sqrt(trace)
    vs, ws, ts, alphas, betas = [], [], [], [], []  # u = A w, t = Aᵀ u

    def orthogonal(vector: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for v in vs:
                vector = vector - (v @ vector) * v
        return vector

    def fresh() -> np.ndarray:
        vector = orthogonal(random.standard_normal(dimensions))
        return vector / np.linalg.norm(vector)

    def small() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.linalg.svd(np.diag(alphas) + np.diag(betas[:len(alphas) - 1], 1))

    v = fresh()
    while True:
        vs.append(v)
        p = v - betas[-1] * ws[-1] if ws else v
        z = product(p)
        for w, t in zip(ws, ts):
            along = w @ z
            p, z = p - along * w, z - along * t
        square = p @ z
        if square > 1e-13 * trace * (p @ p):
            alpha = float(np.sqrt(square))
            w, t = p / alpha, z / alpha
        else:  # A v adds no direction to the u's
            alpha, w, t = 0.0, np.zeros(dimensions), np.zeros(dimensions)
        alphas.append(alpha), ws.append(w), ts.append(t)
        if len(vs) == dimensions:
            break
        rest = orthogonal(t - alpha * v)
        beta = float(np.linalg.norm(rest))
        if beta <= tiny:  # an invariant subspace is complete: start again beside it
            betas.append(0.0)
            v = fresh()
            continue
        betas.append(beta)
        v = rest / beta
        if dimensions > WHOLE and len(vs) > wanted:
            left, values, _ = small()
            if (beta * np.abs(left[-1, :wanted]) <= 1e-14 * values[0]).all():
                break
    _, values, right = small()
    return np.column_stack(vs) @ right.T, values


def fit(x: DataFrame, components: int = COMPONENTS, seed: int = 7) -> Whitening | None:
    """The whitening of ``x`` (distinct, of one length, written): None for an empty table."""
    first = x.select(F.size("x").alias("d")).first()
    if first is None:
        return None
    d, low = first["d"], (1 << _SPLIT) - 1

    def halves(rows: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(rows)], (rows & low).sum(0), (rows >> _SPLIT).sum(0)])

    count, *sums = _total(x.select("x"), 2 * d + 1, halves, "bigint")
    model = Whitening(count, [a + (b << _SPLIT) for a, b in zip(sums[:d], sums[d:])], np.empty((d, 0)), np.empty(0), 0.0)
    centred = model.centred
    model.trace = float(_total(x.select("x"), 1, lambda rows: np.array([(centred(rows)**2).sum()]))[0]) / count
    if model.trace == 0.0:
        model.identity_error = 0.0
        return model

    def product(p: np.ndarray) -> np.ndarray:
        def both(rows: np.ndarray) -> np.ndarray:
            own = centred(rows)
            return own.T @ (own @ p)

        return np.array(_total(x.select("x"), d, both)) / count

    vectors, deviations = bidiagonalise(product, d, components, model.trace, seed)
    kept = [i for i in range(min(components, len(deviations))) if deviations[i]**2 > NOISE * deviations[0]**2]
    chosen = vectors[:, kept]
    chosen = chosen * np.sign(chosen[np.abs(chosen).argmax(0), range(len(kept))])  # the largest entry is positive
    model.components, model.variances = chosen, deviations[kept]**2
    whiten, k = model.components / np.sqrt(model.variances), len(kept)

    def moments(rows: np.ndarray) -> np.ndarray:
        own = centred(rows) @ whiten
        return np.concatenate([own.sum(0), (own.T @ own).ravel()])

    found = np.array(_total(x.select("x"), k * k + k, moments)) / count
    covariance = found[k:].reshape(k, k) - np.outer(found[:k], found[:k])
    model.identity_error = float(np.abs(covariance - np.eye(k)).max())
    return model


def apply(x: DataFrame, model: Whitening) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``, a row for each of ``x`` and each component."""
    k = len(model.variances)
    whiten, explained = model.components / np.sqrt(model.variances), model.variances / model.trace
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            x_, size = _matrix(batch.column(1)), batch.num_rows
            centred = model.centred(x_)
            fits = ((centred * model.count)**2).sum(1) < 9.2e18
            exact = (model.count * (x_ - model.base) - model.rest)**2
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(np.arange(size), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                pa.array(np.full(size * k, model.count, np.int64)),
                pa.array(np.repeat(exact.sum(1), k), mask=np.repeat(~fits, k)),
                pa.array((centred @ whiten).ravel()),
                pa.array(np.tile(explained, size)),
                pa.array(np.full(size * k, model.identity_error)),
            ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return x.mapInArrow(rows, schema)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """The whitened coordinates of every usable row of ``vectors``, by the whitening fitted on all distinct ones.

    ``vectors`` needs ``vec_id`` and ``embedding``; other columns are ignored.
    Vectors that are null, empty or hold a null or non-finite entry (or one of 2^47
    or more, which has no exact integer) take no part, nor do those whose length is
    not the most frequent one (of equally frequent ones the longest). Repeated
    vectors count once for the fit and are returned each time they occur, null ids
    included. Directions without variance have no component, so a table with fewer
    than two distinct vectors gives no rows, nor does an empty one. ``deviation`` is
    exact, or null where it would not fit a long. Signs are fixed by the largest
    entry; sums are added in the order of tasks, so reruns agree.
    """
    spark = vectors.sparkSession
    longest = integers(vectors).groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if longest is None:
        return apply(spark.createDataFrame([], "vec_id bigint, x array<bigint>"), Whitening(1, [0], np.empty((1, 0)), np.empty(0), 1.0))
    x = written(integers(vectors).where(F.size("x") == longest["d"]), "integers")
    return apply(x, fit(written(x.select("x").distinct(), "fit-list"), components))
