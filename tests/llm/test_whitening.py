"""Embedding whitening against plain Python and numpy."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import queries, whitening

SF = "/root/testdata/sf0.01"


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("y", F.lit("x")).withColumn("component", F.lit(1)).withColumn("n", F.lit(2))


def brute(rows, components=16):
    """vec_id -> list of (n, deviation), and by component the whitened column, for vectors of one length."""
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in rows])
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(0)
    centred = fit - total / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    deviations = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, total)) for row in x]
    return n, deviations, values, values / np.trace(centred.T @ centred / n), (x - total / n) @ vectors / np.sqrt(values)


def check(rows, found, components=16, tolerance=1e-8):
    n, deviations, values, shares, expected = brute(rows, components)
    by = {}
    for r in found:
        by.setdefault(r["component"], {}).setdefault(r["vec_id"], r)
    assert sorted(by) == list(range(1, expected.shape[1] + 1))
    for k, of in by.items():
        got = np.array([of[i]["whitened"] for i, _ in rows])
        assert min(np.abs(got - expected[:, k - 1]).max(), np.abs(got + expected[:, k - 1]).max()) < tolerance
        assert all(of[i]["n"] == n and of[i]["deviation"] == d for (i, _), d in zip(rows, deviations))
        assert all(abs(of[i]["explained"] / shares[k - 1] - 1) < 1e-9 for i, _ in rows)
        assert all(of[i]["identity_error"] < 1e-9 for i, _ in rows)


def random_rows(n, d, seed=1, scale=1.0):
    v = np.random.default_rng(seed).normal(size=(n, d)) * scale
    return [(i, r.tolist()) for i, r in enumerate(v)]


def faddeev(matrix):
    """e_0 .. e_d by traces of powers."""
    d = len(matrix)
    b, out = [[Fraction(0)] * d for _ in range(d)], [Fraction(1)]
    for k in range(1, d + 1):
        for i in range(d):
            b[i][i] += out[-1]
        b = [[sum(matrix[i][m] * b[m][j] for m in range(d)) for j in range(d)] for i in range(d)]
        out.append(-sum(b[i][i] for i in range(d)) / k)
    return [int(c) * (-1) ** k for k, c in enumerate(out)]


def test_characteristic_polynomial_is_exact(spark):
    for d, seed in ((1, 0), (2, 1), (5, 2), (7, 3)):
        a = np.random.default_rng(seed).integers(-(10**9), 10**9, (d, d)).astype(object)
        m = a @ a.T
        m[0, :], m[:, 0] = (0, 0) if seed == 2 else (m[0, :], m[:, 0])  # a zero row needs pivots
        assert whitening.characteristic(spark, m) == faddeev(m.tolist())


def test_roots_are_enclosed_as_often_as_they_occur():
    coefficients = [1]
    for root in (9, 9, 9, 4, 2, 0):
        coefficients = [a - root * b for a, b in zip([*coefficients, 0], [0, *coefficients])]
    assert [whitening.roots_above(coefficients, x, 0) for x in (-1, 0, 3, 4, 8, 9)] == [6, 5, 4, 3, 3, 0]
    for k, root in enumerate((9, 9, 9, 4, 2), 1):
        low, high, bits = whitening.enclose(coefficients, k, 33)
        assert low < root << bits <= high and (high - low) << 160 < 33 << bits


def test_sums_are_exact_beyond_64_bits():
    y = np.array([[2**61, -(2**61) + 3], [5, -7], [-(2**40), 2**22]], np.int64)
    found = whitening.Scatter(2)
    found.add(y)
    found.flush()
    plain = [[int(v) for v in r] for r in y]
    assert found.products.tolist() == [[sum(r[i] * r[j] for r in plain) for j in range(2)] for i in range(2)]
    assert list(found.total) == [sum(r[i] for r in plain) for i in range(2)]


@pytest.mark.parametrize(("n", "d", "scale"), [(300, 24, 1.0), (50, 3, 0.3), (40, 5, 1e6)])
def test_agrees_with_an_eigenvalue_solver(spark, n, d, scale):
    rows = random_rows(n, d, scale=scale)
    df = frame(spark, rows).repartition(5)
    check(rows, whitening.whiten(df, whitening.learn(df)).collect())


def test_registered_query(spark):
    df = queries.read_table(spark, SF, "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    found = queries.op13_whitening(spark, SF)
    assert dict(found.dtypes)["deviation"] == "bigint" and found.count() == 16 * len(rows)
    check(rows, found.collect())


def test_equal_eigenvalues_give_an_orthonormal_basis(spark):
    # The corners of a box: the covariance is diagonal, with one eigenvalue three times.
    rows = [(i, [1.0 if i >> k & 1 else -1.0 for k in range(3)] + [4.0 if i >> 3 & 1 else -4.0]) for i in range(16)]
    df = frame(spark, rows)
    models = whitening.learn(df)
    assert np.allclose(models[4].components.T @ models[4].components, np.eye(4), atol=1e-14)
    assert models[4].eigenvalues.tolist() == [256.0**2, 64.0**2, 64.0**2, 64.0**2] and models[4].identity_error < 1e-12


def test_zero_eigenvalues_and_equal_vectors(spark):
    flat = [(i, [float(i), 2.0 * i, 7.0]) for i in range(10)]
    df = frame(spark, flat)
    found = whitening.whiten(df, whitening.learn(df)).collect()
    assert len(found) == 30
    assert all((r["whitened"] is None) == (r["component"] > 1) and r["explained"] == (1.0 if r["component"] == 1 else 0.0) for r in found)
    same = frame(spark, [(i, [1.0, 2.0]) for i in range(4)])
    found = whitening.whiten(same, whitening.learn(same)).collect()
    assert len(found) == 8 and {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in found} == {(1, 0, None, None, 0.0)}


def test_copies_count_once_and_odd_rows_not_at_all(spark):
    nan, inf = float("nan"), float("inf")
    rows = random_rows(60, 6)
    odd = [(900, None), (901, []), (902, [nan] + [1.0] * 5), (903, [inf] + [1.0] * 5), (904, [None] + [1.0] * 5), (905, [1e300] + [1.0] * 5)]
    copies = [(200 + i, rows[3][1]) for i in range(40)] + [(None, rows[4][1]), rows[5], rows[5]]
    df = frame(spark, rows + odd + copies)
    found = whitening.whiten(df, whitening.learn(df)).collect()
    assert len(found) == 6 * (60 + 43) and {r["n"] for r in found} == {60}
    check(rows, [r for r in found if r["vec_id"] is not None and r["vec_id"] < 60])
    assert sum(r["vec_id"] is None for r in found) == 6 and sum(r["vec_id"] == 5 for r in found) == 18


def test_two_lengths_are_whitened_apart(spark):
    short, long = random_rows(30, 2), [(100 + i, v) for i, v in random_rows(50, 4, seed=2)]
    df = frame(spark, short + long)
    found = whitening.whiten(df, whitening.learn(df)).collect()
    check(short, [r for r in found if r["vec_id"] < 100])
    check(long, [r for r in found if r["vec_id"] >= 100])


def test_empty_table(spark):
    df = frame(spark, [(1, None)]).limit(0)
    assert whitening.learn(df) == {}
    assert whitening.whiten(df, {}).count() == 0
