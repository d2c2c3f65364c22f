"""Whitening against numpy and exact fractions."""

import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymart.llm import registry, whiten
from tallymart.llm.common import share_code, table

SCHEMA = "vec_id long, embedding array<float>, label int"
COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def polynomial(matrix):
    """Faddeev-LeVerrier in fractions."""
    d = len(matrix)
    c, m = [Fraction(1)], [[Fraction(0)] * d for _ in range(d)]
    for k in range(1, d + 1):
        m = [[sum(matrix[i][l] * m[l][j] for l in range(d)) + (c[-1] if i == j else 0)
              for j in range(d)] for i in range(d)]
        trace = sum(sum(matrix[i][l] * m[l][i] for l in range(d)) for i in range(d))
        c.append(-trace / k)
    return [int(x) for x in reversed(c)]


def scatter_of(rng, d, n, size=10**6):
    x = [[rng.randrange(-size, size) for _ in range(d)] for _ in range(n)]
    s = [sum(r[i] for r in x) for i in range(d)]
    return [[n * sum(r[i] * r[j] for r in x) - s[i] * s[j] for j in range(d)] for i in range(d)]


@pytest.mark.parametrize("d, n", [(1, 4), (2, 3), (5, 9), (9, 4), (12, 40)])
def test_characteristic_polynomial(spark, d, n):
    share_code(spark)
    m = scatter_of(random.Random(d), d, n)
    assert whiten.characteristic_polynomial(spark, m) == polynomial(m)


def test_diagonal_and_zero_blocks(spark):
    share_code(spark)
    m = [[5, 0, 0, 0], [0, 5, 0, 0], [0, 0, 0, 0], [0, 0, 0, 2]]
    p = whiten.characteristic_polynomial(spark, m)
    assert p == polynomial(m)
    roots = whiten.largest_roots(p, 12, 4)
    scale = 1 << (whiten.ROOT_BITS - 4)
    assert [(round(r / scale, 9), k) for r, k in roots] == [(5.0, 2), (2.0, 1)]
    plane = whiten.null_space(m, 12, *roots[0])
    assert np.allclose(plane @ plane.T, np.eye(2)) and np.allclose(plane[:, 2:], 0)


def test_roots_that_lie_close_together():
    roots = [10**12, 10**12 + 1, 10**12 + 1, 7, 0, 0]
    p = [1]
    for r in roots:
        p = [a - r * b for a, b in zip([0, *p], [*p, 0])]
    trace = sum(roots)
    scale = 1 << (whiten.ROOT_BITS - trace.bit_length())
    assert [(r / scale, k) for r, k in whiten.largest_roots(p, trace, 8)] == [
        (10**12 + 1, 2), (10**12, 1), (7, 1)]


def test_exact_products_of_large_entries():
    rng = np.random.default_rng(1)
    y = rng.integers(-2**62, 2**62, (20, 3))
    want = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(3)]
            for i in range(3)]
    assert whiten.exact_products(y).tolist() == want


def brute_force(x):
    """n, deviations and covariance of integer rows."""
    n, s = len(x), x.sum(axis=0)
    apart = (n * x.astype(object) - s.astype(object))
    v = np.cov(x.T.astype(float), bias=True).reshape(x.shape[1], x.shape[1])
    return n, (apart * apart).sum(axis=1), v, apart.astype(float) / n


def check(got, vectors):
    """``vectors`` by vec_id; vec_ids are distinct."""
    ids = sorted(vectors)
    x = np.floor(1024 * np.array([vectors[i] for i in ids], dtype=float)).astype(np.int64) + 100_000
    n, deviation, v, apart = brute_force(x)
    values, basis = np.linalg.eigh(v)
    values, basis = values[::-1], basis[:, ::-1]
    k = min(8, int((values > 1e-9 * values[0]).sum()))
    rows = {(r["vec_id"], r["component"]): r for r in got.collect()}
    assert len(rows) == len(ids) * k and {c for _, c in rows} == set(range(1, k + 1))
    for c in range(1, k + 1):
        column = [rows[i, c] for i in ids]
        assert all(r["n"] == n and r["deviation"] == w for r, w in zip(column, deviation))
        assert all(abs(r["explained"] / (values[c - 1] / np.trace(v)) - 1) < 1e-9 for r in column)
        assert all(r["identity_error"] < 1e-9 for r in column)
        mine = np.array([r["whitened"] for r in column])
        theirs = apart @ basis[:, c - 1] / np.sqrt(values[c - 1])
        assert min(np.abs(mine - theirs).max(), np.abs(mine + theirs).max()) < 1e-7


def test_whole_table(spark, sf_small):
    got = registry.queries()["op11_polynomial_whitening"](spark, sf_small)
    assert got.columns == COLUMNS
    rows = table(spark, sf_small, "embeddings").collect()
    check(got, {r["vec_id"]: r["embedding"] for r in rows})


def test_awkward_rows(spark):
    share_code(spark)
    rng = np.random.default_rng(3)
    good = {i: np.float32(rng.normal(size=5)).tolist() for i in range(40)}
    bad = [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [float("nan")] * 5),
           (103, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (104, [1.0, 2.0]), (105, [])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in [*good.items(), *bad]], SCHEMA)
    for name in ("v", "whitened", "component", "n", "deviation", "p", "place"):
        frame = frame.withColumn(name, F.lit("extra"))
    check(whiten.whiten(frame), good)


def test_repeated_rows_and_null_ids(spark):
    share_code(spark)
    rows = [(1, [0.5, 0.25]), (1, [0.5, 0.25]), (None, [0.0, 1.0]), (2, [0.75, -1.0])]
    got = whiten.whiten(spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA)).collect()
    assert sorted(str(r["vec_id"]) for r in got) == ["1"] * 4 + ["2"] * 2 + ["None"] * 2
    assert all(r["n"] == 4 and r["identity_error"] < 1e-12 for r in got)


def test_equal_eigenvalues(spark):
    share_code(spark)
    corners = [[a, b, c] for a in (-1.0, 1.0) for b in (-1.0, 1.0) for c in (-1.0, 1.0)]
    got = whiten.whiten(spark.createDataFrame(
        [(i, v, 0) for i, v in enumerate(corners)], SCHEMA)).collect()
    assert len(got) == 24 and all(abs(r["explained"] - 1 / 3) < 1e-12 for r in got)
    assert all(r["identity_error"] < 1e-12 for r in got)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, None)]])
def test_nothing_to_whiten(spark, rows):
    share_code(spark)
    got = whiten.whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA))
    assert got.columns == COLUMNS and got.count() == 0


def test_deviation_beyond_a_long():
    y = np.array([[2**61], [-2**61]])
    apart, squares = whiten.deviations(y, 2, [0])
    assert squares == [None, None] and apart[0, 0] == 2.0**62
