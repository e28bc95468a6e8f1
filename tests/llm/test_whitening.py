"""Whitening against plain exact arithmetic and numpy."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from tallygrid.llm import whitening

SHAPE = "vec_id long, embedding array<float>"
EXACT = "vec_id long, embedding array<double>"


def found(spark, rows, shape=SHAPE, **how):
    return whitening.whitened(spark.createDataFrame(rows, shape).repartition(3), **how).collect()


def vectors(seed, n, size):
    draw = random.Random(seed)
    turn = [[draw.gauss(0, 1) for _ in range(size)] for _ in range(size)]
    return [(i, [float(np.float32(sum(t * draw.gauss(0, 0.1 * (k + 1)) for k, t in enumerate(row)))) for row in turn])
            for i in range(n)]


def matrix(rows):
    return np.array([[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows], dtype=object)


def exact_covariance(x):
    n, sums = len(x), x.sum(axis=0)
    off = [[n * int(c) - int(s) for c, s in zip(row, sums)] for row in x]
    return [[Fraction(sum(r[i] * r[j] for r in off), n**3) for j in range(x.shape[1])] for i in range(x.shape[1])]


def test_against_exact_arithmetic(spark):
    rows = vectors(1, 90, 11)
    x = matrix(rows)
    n, sums = len(x), x.sum(axis=0)
    exact = exact_covariance(x)
    values, turned = np.linalg.eigh(np.array([[float(c) for c in row] for row in exact]))
    got = found(spark, rows)
    assert len(got) == 90 * 8
    for r in got:
        row, k = x[r["vec_id"]], r["component"]
        assert r["n"] == n
        assert r["deviation"] == sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums))
        off = np.array([float(Fraction(n * int(c) - int(s), n)) for c, s in zip(row, sums)])
        expected = off @ turned[:, -k] / math.sqrt(values[-k])
        assert abs(r["whitened"]) == pytest.approx(abs(expected), rel=1e-9, abs=1e-9)
        assert r["explained"] == pytest.approx(values[-k] / values.sum(), rel=1e-12)
        assert 0 <= r["identity_error"] < 1e-9
    one = [r["whitened"] for r in sorted(got, key=lambda r: r["vec_id"]) if r["component"] == 2]
    expected = [float(Fraction(1, n)) * sum((n * int(c) - int(s)) * t for c, s, t in zip(row, sums, turned[:, -2])) for row in x]
    signs = {np.sign(a * b) for a, b in zip(one, expected) if abs(a) > 1e-6}
    assert len(signs) == 1


def test_covariances_are_exact():
    """Polarisation gives each covariance to the last digit, far from zero too."""
    x = np.array([[10**9 + 3, 5, 7], [10**9, 6, -10**12], [10**9 + 1, 6, 2], [10**9 + 3, 4, 10**12]], dtype=object)
    n = len(x)
    low = [int(s) // n for s in x.sum(axis=0)]
    rest = [int(s) - n * m for s, m in zip(x.sum(axis=0), low)]
    squares = {(i, i + k): int(v) for i, part in whitening._squares(low)(x) for k, v in enumerate(part)}
    exact = exact_covariance(x)
    got = whitening.covariances(n, rest, squares)
    assert got.tolist() == [[float(c) for c in row] for row in exact]


def test_rows_that_are_left_out(spark):
    good = vectors(2, 30, 4)
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [1.0, float("nan"), 2.0, 3.0]),
           (103, [float("inf"), 0.0, 0.0, 0.0]), (104, [-math.inf, 0.0, 0.0, 0.0]), (105, [1.0]), (106, [])]
    got, alone = found(spark, good + bad), found(spark, good)
    assert {r["vec_id"] for r in got} == set(range(30))
    assert len(got) == 30 * 4  # as many components as dimensions
    assert got[0]["n"] == 30
    assert sorted(r["deviation"] for r in got) == sorted(r["deviation"] for r in alone)


def test_null_ids_and_repeated_rows_are_rows(spark):
    rows = vectors(3, 20, 3) + [(None, [0.5, 0.25, 0.125])] * 2 + [(4, [0.5, 0.25, 0.125])]
    got = found(spark, rows)
    assert len(got) == 23 * 3
    assert sum(r["vec_id"] is None for r in got) == 6 and sum(r["vec_id"] == 4 for r in got) == 6


def test_without_variance(spark):
    for rows in ([(1, [0.5, 0.25])], [(1, [0.5, 0.25]), (2, [0.5, 0.25])]):
        got = found(spark, rows)
        assert {(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in got} == {(0, None, None, None)}
    flat = found(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)])
    by = {k: {r["whitened"] is None for r in flat if r["component"] == k} for k in (1, 2, 3)}
    assert by == {1: {False}, 2: {True}, 3: {True}}
    assert max(r["identity_error"] for r in flat) < 1e-9


def test_empty_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None), (2, [])]) == []


def test_huge_entries(spark):
    rows = [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [3e18, 4.0]), (4, [0.5, -1.0])]
    got = found(spark, rows, EXACT)
    assert len(got) == 8
    assert {r["deviation"] for r in got} == {None}
    assert all(math.isfinite(r["whitened"] or 0.0) for r in got)


def test_extra_columns_with_clashing_names(spark):
    rows = [(*r, "x", 1, 2.0, "y", "z") for r in vectors(4, 12, 3)]
    got = found(spark, rows, SHAPE + ", v string, n int, component double, whitened string, i string")
    assert len(got) == 36
