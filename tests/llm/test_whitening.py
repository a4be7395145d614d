import math
import random
from fractions import Fraction

import numpy as np
import pytest

from cdclake.llm import spectrum, whitening

SCHEMA = "vec_id long, embedding array<double>"


def grid(vector):
    return [math.floor(64 * c) + 1_000_000 for c in vector]


def whitened(spark, rows, schema=SCHEMA, **more):
    out = whitening.whiten(spark.createDataFrame(rows, schema).repartition(3), **more).collect()
    return {(r["vec_id"], r["component"]): r for r in out}, out


def normal(seed, n, dim):
    rng = np.random.default_rng(seed)
    return [[float(v) for v in row] for row in rng.normal(size=(n, dim)) @ rng.normal(size=(dim, dim))]


def test_values_are_those_of_a_plain_decomposition(spark):
    vectors = normal(1, 300, 40)
    got, rows = whitened(spark, list(enumerate(vectors)))
    assert len(rows) == 300 * 32
    x = np.array([grid(v) for v in vectors], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    centred = (x - sums / Fraction(n)).astype(float)
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    values, turn = values[::-1], turn[:, ::-1]
    for k in range(32):
        mine = np.array([got[i, k + 1]["whitened"] for i in range(n)])
        plain = centred @ turn[:, k] / math.sqrt(values[k])
        assert min(np.abs(mine - plain).max(), np.abs(mine + plain).max()) < 1e-9
        assert got[0, k + 1]["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-9)
    for i in range(n):
        assert got[i, 1]["deviation"] == sum((n * v - s) ** 2 for v, s in zip(x[i], sums))
    assert {r["n"] for r in rows} == {n}
    assert {r["identity_error"] for r in rows} == {rows[0]["identity_error"]} and rows[0]["identity_error"] < 1e-9


def test_polynomial_is_exact(spark):
    rng = random.Random(2)
    rows = [[rng.randint(-9, 9) for _ in range(6)] for _ in range(9)]
    matrix = [[sum(r[i] * r[j] for r in rows) for j in range(6)] for i in range(6)]
    # Newton's identities on traces of powers.
    power, sums = [[int(i == j) for j in range(6)] for i in range(6)], []
    for _ in range(6):
        power = [[sum(a * matrix[m][j] for m, a in enumerate(row)) for j in range(6)] for row in power]
        sums.append(sum(power[i][i] for i in range(6)))
    plain = [1]
    for k in range(1, 7):
        plain.append(-sum(plain[k - j] * sums[j - 1] for j in range(1, k + 1)) // k)
    assert spectrum.characteristic_polynomial(spark, matrix) == plain[::-1]


def test_roots_are_told_apart_and_counted():
    # (x - 3)^2 (x - 5) x^2, and two roots that differ by 2^-60 of themselves.
    polynomial = [0, 0, -45, 39, -11, 1]
    assert [(r.value, r.times) for r in spectrum.isolated_roots(polynomial, 9)] == [(5, 1), (3, 2), (0, 2)]
    big = 1 << 60
    close = [big * (big + 1), -(2 * big + 1), 1]
    high, low = spectrum.isolated_roots(close, 2)
    assert abs(high.value - big - 1) < Fraction(1, 1 << 60) and abs(low.value - big) < Fraction(1, 1 << 60)
    assert [p for p in spectrum.primes(90)][:3] == [2147483647, 2147483629, 2147483587]


def test_vectors_of_close_and_repeated_eigenvalues():
    matrix = [[1 << 40, 1, 0], [1, 1 << 40, 0], [0, 0, 5]]
    roots = spectrum.isolated_roots([-5 * ((1 << 80) - 1), (1 << 80) - 1 + 10 * (1 << 40), -((1 << 41) + 5), 1], 3)
    vectors = [spectrum.null_vectors(matrix, r)[0] for r in roots]
    half = math.sqrt(0.5)
    expected = [[half, half, 0], [half, -half, 0], [0, 0, 1]]
    for v, e in zip(vectors, expected):
        assert max(abs(abs(a) - abs(b)) for a, b in zip(v, e)) < 1e-15
    space = spectrum.null_vectors([[7, 0, 0], [0, 7, 0], [0, 0, 1]], spectrum.Root(Fraction(7), Fraction(7), 2, Fraction(6)))
    assert np.abs(np.array(space) @ np.array(space).T - np.eye(2)).max() < 1e-15


def test_unusable_rows_are_dropped(spark):
    good = [(k, v) for k, v in enumerate(normal(3, 20, 4))]
    bad = [(50, None), (51, []), (52, [1.0, None, 2.0, 3.0]), (53, [1.0, float("nan"), 0.0, 0.0]), (54, [float("inf")] * 4), (55, [1.0, 2.0])]
    plain, _ = whitened(spark, good)
    got, rows = whitened(spark, good + bad)
    assert len(rows) == 80 and set(got) == set(plain)
    assert all(got[k]["deviation"] == plain[k]["deviation"] and got[k]["n"] == 20 for k in plain)


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    vectors = normal(4, 10, 3)
    rows = [(None, 1, v) for v in vectors] + [(7, 2, vectors[0])] * 5
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id int, whitened int, embedding array<double>")).collect()
    assert len(out) == 45 and sum(r["vec_id"] == 7 for r in out) == 15 and {r["n"] for r in out} == {15}
    assert out[0]["identity_error"] < 1e-12


def test_dimensions_without_variance(spark):
    vectors = [[float(k), 2.0 * k, 1.0, 0.0] for k in range(9)]
    got, _ = whitened(spark, list(enumerate(vectors)))
    assert [got[3, c]["explained"] for c in (1, 2, 3, 4)] == [1.0, 0.0, 0.0, 0.0]
    assert got[3, 1]["whitened"] is not None and got[3, 2]["whitened"] is None and got[3, 1]["identity_error"] < 1e-12
    same, rows = whitened(spark, [(k, [1.5, 2.5]) for k in range(3)])
    assert len(rows) == 6 and all(r["whitened"] is None and r["explained"] is None and r["identity_error"] is None and r["deviation"] == 0 for r in rows)


def test_entries_of_any_size_are_exact(spark):
    vectors = [[1e300, 1.0, -2e4], [-1e300, 2.0, 3e9], [1e12, 1e-300, 4.0], [0.25, -1e15, 7e5]] * 3
    got, rows = whitened(spark, list(enumerate(vectors)))
    top = 1 << 62
    x = [[min(max(math.floor(64 * c) if abs(c) < 1e17 else int(c), -top), top) for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    for k, v in enumerate(x):
        exact = sum((n * a - s) ** 2 for a, s in zip(v, sums))
        assert got[k, 1]["deviation"] == (exact if exact < 1 << 63 else None)
    assert rows[0]["identity_error"] < 1e-6


def test_no_rows(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], SCHEMA)).count() == 0


def test_sums_of_many_rows_and_large_entries_are_exact():
    rng = np.random.default_rng(5)
    sums, plain, total = whitening._Sums(3), np.zeros((3, 3), dtype=object), np.zeros(3, dtype=object)
    for k in range(400):
        y = rng.integers(-(1 << (1 + k % 62)), 1 << (1 + k % 62), (50, 3))
        sums.add(y)
        big = y.astype(object)
        plain += big.T @ big
        total += big.sum(axis=0)
    assert sums.cells() == [20_000, *total, *plain[np.triu_indices(3)]]
    table = whitening._digits([-5, 1 << 70, -(1 << 90) - 7, 0]).to_pylist()
    back = [0] * 4
    for r in table:
        back[r["cell"]] += r["digit"] << (30 * r["place"])
    assert back == [-5, 1 << 70, -(1 << 90) - 7, 0]
