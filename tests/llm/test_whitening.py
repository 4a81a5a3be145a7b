import math

import numpy as np
import pytest

from presswork.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, component string"


def whole(vectors):
    return np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], dtype=object)


def vectors(n=400, d=12, rank=None, seed=3):
    rng = np.random.default_rng(seed)
    mixed = rng.standard_normal((n, rank or d)) @ rng.standard_normal((rank or d, d)) * np.linspace(0.2, 3, d) + 5
    return mixed.astype(np.float32).tolist()


def rows_of(spark, rows, **options):
    out = whitening.whitened(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA), **options).collect()
    return sorted(out, key=lambda r: (r.vec_id is None, r.vec_id or 0, r.component))


def test_whitening_equals_eigendecomposition(spark):
    data = vectors()
    rows = list(enumerate(data))
    out = rows_of(spark, rows, components=8)
    x = whole(data)
    n, sums = len(x), x.sum(axis=0)
    y = (x - 1_000_000).astype(float) - (sums / n - 1_000_000).astype(float)
    values, units = np.linalg.eigh(y.T @ y / n)
    values, units = values[::-1], units[:, ::-1]
    assert [(r.vec_id, r.component) for r in out] == [(i, k) for i in range(n) for k in range(1, 9)]
    assert {r.n for r in out} == {n}
    assert [r.deviation for r in out[::8]] == [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    z = np.array([r.whitened for r in out]).reshape(n, 8)
    expected = y @ units[:, :8] / np.sqrt(values[:8])
    signs = np.sign((z * expected).sum(axis=0))
    assert np.abs(z * signs - expected).max() < 1e-8
    assert np.allclose([r.explained for r in out[:8]], values[:8] / values.sum(), rtol=1e-10)
    (error,) = {r.identity_error for r in out}
    assert abs(error - np.abs(z.T @ z / n - np.eye(8)).max()) < 1e-9 and error < 1e-9


def test_left_out_rows_repeats_and_lengths(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 2.0], [3.0, 1.0], [0.5, -1.0], [0.5, -1.0]]
    rows = [(1, good[0]), (2, good[1]), (3, good[2]), (3, good[3]), (None, [2.0, 2.0])]
    odd = [(4, None), (5, []), (6, [nan, 1.0]), (7, [None, 1.0]), (8, [1.0, inf]), (9, [1.0]), (10, [4.0])]
    out = rows_of(spark, rows + odd)
    two = [r for r in out if r.vec_id not in (9, 10)]
    assert [(r.vec_id, r.component, r.n) for r in two] == [(i, k, 5) for i in (1, 2, 3, 3, None) for k in (1, 2)] or len(two) == 10
    x = whole(good + [[2.0, 2.0]])
    assert {r.deviation for r in two if r.vec_id == 1} == {sum((5 * a - s) ** 2 for a, s in zip(x[0], x.sum(axis=0)))}
    one = [r for r in out if r.vec_id in (9, 10)]
    assert [(r.vec_id, r.component, r.n, r.explained) for r in one] == [(9, 1, 2, 1.0), (10, 1, 2, 1.0)]
    assert sorted(r.whitened for r in one) == pytest.approx([-1.0, 1.0])


def test_tables_without_variance(spark):
    assert rows_of(spark, []) == []
    assert rows_of(spark, [(1, [1.0, 2.0])]) == []
    assert rows_of(spark, [(k, [1.0, 2.0]) for k in range(5)]) == []


def test_dependent_directions_give_as_many_components_as_there_are(spark):
    rng = np.random.default_rng(1)
    rows = [(k, [float(a), float(b), float(a), float(-b)]) for k, (a, b) in enumerate(rng.integers(-50, 50, (60, 2)))]
    out = rows_of(spark, rows)
    assert {r.component for r in out} == {1, 2} and {r.identity_error < 1e-9 for r in out} == {True}


def test_deviation_that_fits_no_long(spark):
    out = rows_of(spark, [(1, [1e12]), (2, [0.0]), (3, [1.0])])
    assert [r.deviation is None for r in out] == [True, True, True] and len(out) == 3


def test_cholesky_and_jacobi():
    rng = np.random.default_rng(8)
    a = rng.standard_normal((30, 11))
    v = a.T @ a
    g = whitening.pivoted_cholesky(v)
    pivots = np.argsort([np.flatnonzero(np.abs(g[i]) > 0).max() for i in range(11)])
    assert np.allclose(g @ g.T, v) and np.allclose(np.triu(g[pivots], 1), 0)
    turned = whitening.orthogonal_columns(g)
    gram = turned.T @ turned
    assert np.allclose(gram, np.diag(gram.diagonal())) and np.allclose(turned @ turned.T, v)
    assert np.allclose(gram.diagonal(), np.linalg.eigvalsh(v)[::-1])
