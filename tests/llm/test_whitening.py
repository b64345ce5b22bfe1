"""Whitening against exact determinants, numpy's eigenvectors and plain integer sums."""

import itertools
from fractions import Fraction

import numpy as np
import pytest

from quadra.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, x string, d string, n string, component string"


def plain_polynomial(matrix):
    """Faddeev and LeVerrier's recurrence in fractions."""
    d = len(matrix)
    m, coefficients = [[Fraction(0)] * d for _ in range(d)], [Fraction(1)]
    for k in range(1, d + 1):
        m = [[sum(Fraction(int(matrix[i][t])) * m[t][j] for t in range(d)) + (coefficients[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        product = [[sum(Fraction(int(matrix[i][t])) * m[t][j] for t in range(d)) for j in range(d)] for i in range(d)]
        coefficients.append(-sum(product[i][i] for i in range(d)) / k)
    return [int(c) for c in reversed(coefficients)]


@pytest.mark.parametrize("seed", range(4))
def test_polynomial_equals_the_recurrence(spark, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-50, 50, (9, 7 if seed else 2))
    matrix = (x.T @ x).astype(object)
    if seed == 3:
        matrix = np.diag([4, 4, 4, 1, 0, 0, 9]).astype(object)
    assert W.characteristic_polynomial(spark, matrix) == plain_polynomial(matrix.tolist())


def test_roots_with_repeats_and_rationals():
    poly = np.array([1], dtype=object)
    for root in (0, 3, 3, 3, 7, 7, 12):
        poly = np.convolve(poly, np.array([-root, 1], dtype=object))
    assert W.greatest_roots(list(poly), 6, 40) == [12, 7, 7, 3, 3, 3]
    assert W.roots_beyond(list(poly), 3, 0) == 3 and W.roots_beyond(list(poly), 5, 1) == 6
    near = np.convolve(np.array([-(10**12), 10**6], dtype=object), np.array([-(10**12) - 1, 10**6], dtype=object))
    a, b = W.greatest_roots(list(near), 2, 10**7)
    assert abs(a - Fraction(10**12 + 1, 10**6)) < Fraction(1, 10**30) and abs(b - 10**6) < Fraction(1, 10**30)


def test_scatter_is_exact_for_wide_entries():
    rng = np.random.default_rng(5)
    x = rng.integers(-(1 << 50), 1 << 50, (300, 3))
    want = sum(np.outer(r, r) for r in x.astype(object))
    assert (W.exact_scatter(x) == want).all()


def checked(rows, found):
    """``found`` (pandas) against numpy on the plain definition."""
    kept = [(i, np.floor(64 * np.array(v, dtype=np.float32).astype(float)).astype(np.int64) + 1_000_000) for i, v in rows]
    fit = np.unique(np.array([x for _, x in kept]), axis=0).astype(object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (fit - sums / n).astype(float)
    cov = centred.T @ centred / n
    values = np.linalg.eigvalsh(cov)[::-1]
    k = found["component"].max()
    assert (found["n"] == n).all() and len(found) == len(kept) * k
    assert found["identity_error"].nunique() == 1 and found["identity_error"].iloc[0] <= 1e-6
    by_id = {i: int(((n * x.astype(object) - sums) ** 2).sum()) for i, x in kept}
    assert all(by_id[i] == v for i, v in zip(found["vec_id"], found["deviation"], strict=True))
    explained = found.groupby("component")["explained"].first().to_numpy()
    assert np.allclose(explained, values[:k] / values.sum(), rtol=1e-9)
    # The vectors themselves: whitened = (x - S/n) W, least squares gives W back.
    table = found.drop_duplicates(["vec_id", "component"]).pivot(index="vec_id", columns="component", values="whitened")
    points = {i: x for i, x in kept}
    a = np.array([(points[i] - (sums / n).astype(float)).astype(float) for i in table.index])
    w = table.to_numpy()
    assert np.allclose(a @ np.linalg.lstsq(a, w, rcond=None)[0], w, atol=1e-7)
    fit_w = centred @ np.linalg.lstsq(a, w, rcond=None)[0]
    assert np.allclose(fit_w.T @ fit_w / n, np.eye(k), atol=1e-6)


def test_equals_numpy_with_copies(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(120, 20)) * np.linspace(0.1, 2, 20)
    rows = [(k, base[k % 100].tolist()) for k in range(240)]
    df = spark.createDataFrame([(i, v, 0, *"abcd") for i, v in rows], SCHEMA).repartition(5)
    found = W.whiten(df).toPandas()
    assert found["component"].max() == 16
    checked(rows, found)


def test_equal_eigenvalues_get_orthogonal_components(spark):
    rows = [(k, [float(s) for s in signs]) for k, signs in enumerate(itertools.product((-1, 1), repeat=5))]
    found = W.whiten(spark.createDataFrame([(i, v, 0, *"abcd") for i, v in rows], SCHEMA)).toPandas()
    assert found["component"].max() == 5
    checked(rows, found)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 1.0, -2.0]), (2, [0.25, 1.0, 3.0]), (3, [9.0, 1.0, -2.5]), (3, [9.0, 1.0, -2.5])]
    bad = [(4, None), (5, []), (6, [1.0, None, 2.0]), (7, [nan, 1.0, 1.0]), (8, [inf, 1.0, 1.0]), (9, [1.0, 2.0]), (10, [1.0] * 400)]
    df = spark.createDataFrame([(i, v, None, *"abcd") for i, v in good + bad], SCHEMA)
    found = W.whiten(df).toPandas()
    # The second entry never varies and three points span a plane: two components.
    assert sorted(set(found["vec_id"])) == [1, 2, 3] and found["component"].max() == 2 and len(found) == 8
    checked(good, found)
    null_id = W.whiten(spark.createDataFrame([(None, [1.0, 2.0], 0, *"abcd"), (2, [2.0, 5.0], 0, *"abcd")], SCHEMA)).toPandas()
    assert null_id["vec_id"].isna().sum() == 1


def test_huge_entries_and_deviations_beyond_a_long(spark):
    df = spark.createDataFrame([(1, [3e38, 0.0], 0, *"abcd"), (2, [-3e38, 1.0], 0, *"abcd"), (3, [0.0, 0.75], 0, *"abcd")], SCHEMA)
    found = W.whiten(df).toPandas()
    assert found["deviation"].isna().sum() == 4 and found["identity_error"].iloc[0] <= 1e-4


def test_nothing_to_fit(spark):
    empty = spark.createDataFrame([], SCHEMA)
    same = spark.createDataFrame([(1, [1.0, 2.0], 0, *"abcd"), (2, [1.0, 2.0], 0, *"abcd")], SCHEMA)
    assert W.whiten(empty).collect() == [] and W.whiten(same).collect() == []
