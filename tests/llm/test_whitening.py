"""Whitening against numpy's eigendecomposition and exact integers; defined cases."""

import math

import numpy as np
import pytest

from martkit.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, n string, component string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "x", "n", "c") for i, v in vectors], SCHEMA)


def brute(vectors, k=4):
    """Expected rows from the definition, in numpy."""
    kept = [(i, v) for i, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in v] for _, v in kept])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    off = fit - sums / n
    values, vectors_ = np.linalg.eigh(off.T @ off / n)
    order = np.argsort(-values)[:k]
    white = (x - sums / n) @ vectors_[:, order] / np.sqrt(values[order])
    return [i for i, _ in kept], n, ((n * x - sums) ** 2).sum(axis=1), white, values[order] / values.sum()


def test_equals_the_definition(spark):
    rng = np.random.default_rng(7)
    mix = rng.standard_normal((9, 9)) * np.linspace(0.2, 2, 9)
    vectors = [(int(i), [float(c) for c in rng.standard_normal(9) @ mix]) for i in range(300)]
    vectors += [(900, vectors[3][1])] * 200 + [(None, vectors[5][1]), (901, vectors[3][1])]
    bad = [(910, None), (911, []), (912, [1.0] * 8 + [None]), (913, [math.nan] * 9), (914, [math.inf] + [0.0] * 8), (915, [1.0] * 3)]
    ids, n, deviations, white, explained = brute(vectors)
    rows = whitening.whiten(spark, table(spark, vectors + bad).repartition(5)).collect()
    assert len(rows) == 4 * len(ids) and {r.n for r in rows} == {n} == {300}
    want = {}
    for i, d, w in zip(ids, deviations, white):
        want.setdefault(i, (int(d), w))
    signs = {}
    for r in rows:
        d, w = want[r.vec_id]
        assert r.deviation == d and abs(r.explained - explained[r.component - 1]) < 1e-9
        if abs(w[r.component - 1]) > 0.1:
            signs.setdefault(r.component, np.sign(r.whitened * w[r.component - 1]))
    for r in rows:
        assert abs(r.whitened - signs[r.component] * want[r.vec_id][1][r.component - 1]) < 1e-8
    assert max(r.identity_error for r in rows) < 1e-9


@pytest.mark.parametrize("vectors, components, spread", [
    ([], 0, 0), ([(1, None)], 0, 0), ([(1, [0.5, 0.25])] * 3, 2, 0),
    ([(1, [0.0, 1.0]), (2, [1.0, 1.0])], 2, 1), ([(1, [1.0]), (2, [2.0]), (3, [4.0])], 1, 1)])
def test_defined_cases(spark, vectors, components, spread):
    rows = whitening.whiten(spark, table(spark, vectors)).collect()
    assert len(rows) == components * len([v for _, v in vectors if v])
    for r in rows:
        assert (r.whitened is not None) == (r.component <= spread)
        assert (r.explained is None) == (spread == 0) and (r.identity_error is None) == (spread == 0)


def test_deviation_stays_exact_and_null_beyond_64_bits(spark):
    rows = whitening.whiten(spark, table(spark, [(1, [2.0**22]), (2, [0.0]), (3, [2.0**21])])).collect()
    got = {r.vec_id: r.deviation for r in rows}
    total = 2**30 + 2**29
    assert got == {1: (3 * 2**30 - total) ** 2, 2: total**2, 3: 0}
    far = whitening.whiten(spark, table(spark, [(1, [2.0**40]), (2, [0.0])])).collect()
    assert {r.deviation for r in far} == {None}


@pytest.mark.parametrize("values", [
    [5.0], [1.0, 1.0, 1.0], [3.0, 3.0, 1.0, 1.0, 1.0], [9.0, 2.0, 1e-3, 0.0, 0.0], [1e8, 1e4, 1.0, 1e-4, 1e-8],
    [2.0, 2.0 - 1e-10, 1.0, 0.5, 0.25, 0.125]])
def test_components_are_eigenvectors(values):
    d = len(values)
    q, _ = np.linalg.qr(np.random.default_rng(d).standard_normal((d, d)))
    a = q * np.array(values) @ q.T
    a = (a + a.T) / 2
    v = whitening.components_of(a, min(4, d))
    found = np.einsum("ij,ij->j", v, a @ v)
    assert np.allclose(found, sorted(values)[::-1][:4], rtol=0, atol=1e-14 * max(values) * d)
    assert np.linalg.norm(a @ v - v * found) < 1e-13 * max(values) * d
    assert np.allclose(v.T @ v, np.eye(v.shape[1]), atol=1e-13)


def test_polar_factor_is_the_matrix_sign():
    a = np.diag([4.0, -1e-6, 2.0, -3.0])
    assert np.allclose(whitening.polar_factor(a), np.diag([1, -1, 1, -1]), atol=1e-12)
