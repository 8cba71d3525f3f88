import numpy as np
import pytest

from starfold.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, x array<int>, component int, v string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], [1], 2, "z") for i, v in rows], SCHEMA)


def brute(rows, k=16):
    """vec_id -> (deviation, whitened up to sign), and the eigenvalues over their sum, of finite rows."""
    kept = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(np.int64) + 1000000) for i, v in rows
            if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array(sorted({tuple(v.tolist()) for _, v in kept}), np.int64)
    n, total = len(x), x.sum(0)
    centred = x - total / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1][:k], basis[:, ::-1][:, :k]
    out = [(i, int(((n * v - total).astype(object)**2).sum()), (v - total / n) @ basis / np.sqrt(values)) for i, v in kept]
    return n, out, values / (centred**2).sum() * n


def random_rows(n, d, seed=3):
    r = np.random.default_rng(seed)
    basis = r.standard_normal((d, d)) * np.linspace(2, 0.2, d)
    return [(i, (r.standard_normal(d) @ basis).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("d, k", [(64, 16), (3, 16), (1, 16)])
def test_against_eigenvectors(spark, d, k):
    rows = random_rows(700, d)
    rows += [(1000 + i, v) for i, v in rows[:9]] * 20
    n, expected, share = brute(rows, min(k, d))
    got = {}
    for r in whitening.whiten(vectors(spark, rows)).collect():
        got.setdefault(r.vec_id, []).append(r)
        assert r.n == n and r.identity_error < 1e-9
        assert r.explained == pytest.approx(share[r.component - 1], rel=1e-9)
    repeated = {i: sum(j == i for j, _ in rows) for i, _ in rows}
    signs = None
    for i, deviation, white in expected:
        own = sorted(got[i], key=lambda r: r.component)[::repeated[i]]
        assert [r.component for r in own] == list(range(1, min(k, d) + 1)) and {r.deviation for r in own} == {deviation}
        mine = np.array([r.whitened for r in own])
        signs = np.sign(mine * white) if signs is None else signs
        assert np.allclose(mine * signs, white, rtol=0, atol=1e-7)


def test_bidiagonalisation_of_repeated_and_missing_directions():
    """Eigenvalues that occur several times and directions without variance still give a whole basis."""
    r = np.random.default_rng(1)
    q, _ = np.linalg.qr(r.standard_normal((20, 20)))
    values = np.array([9.0] * 3 + [4.0] * 5 + [1.0] * 4 + [0.0] * 8)
    gram = (q * values) @ q.T
    found, deviations = whitening.bidiagonalise(lambda p: gram @ p, 20, 16, values.sum())
    assert np.allclose(deviations**2, values, atol=1e-8)
    assert np.allclose(found.T @ found, np.eye(20), atol=1e-10)
    assert np.allclose(gram @ found[:, :12], found[:, :12] * values[:12], atol=1e-8)


def test_long_vectors_stop_when_converged(monkeypatch):
    monkeypatch.setattr(whitening, "WHOLE", 0)
    r, calls = np.random.default_rng(2), []
    q, _ = np.linalg.qr(r.standard_normal((300, 300)))
    values = 0.8 ** np.arange(300)
    gram = (q * values) @ q.T
    found, deviations = whitening.bidiagonalise(lambda p: calls.append(1) or gram @ p, 300, 8, values.sum())
    assert len(calls) < 150
    assert np.allclose(deviations[:8]**2, values[:8], rtol=1e-10) and np.allclose(np.abs((found[:, :8] * q[:, :8]).sum(0)), 1, atol=1e-8)


def test_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1, 2]), (2, [3, -1]), (2, [3, -1]), (None, [0, 5]), (4, None), (5, []), (6, [1, None]), (7, [nan, 1]), (8, [1, -inf]),
            (9, [1, 2, 3]), (10, [1e30, 1]), (11, [-2, 1])]
    got = whitening.whiten(vectors(spark, rows)).collect()
    assert sorted(((r.vec_id or 0), r.component) for r in got) == [(0, 1), (0, 2), (1, 1), (1, 2), (2, 1), (2, 1), (2, 2), (2, 2), (11, 1), (11, 2)]
    assert {r.n for r in got} == {4}
    flat = whitening.whiten(vectors(spark, [(1, [1, 7]), (2, [2, 7]), (3, [4, 7])])).collect()
    assert {r.component for r in flat} == {1} and all(r.explained == pytest.approx(1.0) for r in flat)
    for none in ([], [(1, [1, 2])], [(1, None)], [(1, [1, 2]), (2, [1, 2])]):
        assert whitening.whiten(vectors(spark, none)).count() == 0


def test_large_deviations_are_null(spark):
    got = whitening.whiten(vectors(spark, [(1, [1e8, 0]), (2, [-1e8, 1]), (3, [0, 2])])).collect()
    assert {r.vec_id: r.deviation is None for r in got} == {1: True, 2: True, 3: False}
