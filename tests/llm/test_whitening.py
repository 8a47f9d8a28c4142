"""Whitening by polarised covariance against exact arithmetic."""

from fractions import Fraction

import numpy as np
import pytest

from planscore.llm import whitening as Z

SCHEMA = "vec_id long, embedding array<float>, whitened string, deviation string, k string, v int"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, "x", "y", "z", 1) for i, v in enumerate(vectors)], SCHEMA)


def sample(n, d, seed=0):
    r = np.random.default_rng(seed)
    v = r.normal(size=(n, d)) @ r.normal(size=(d, d)) + 3
    return [[float(np.float32(c)) for c in x] for x in v]


def integers(vectors, scale=64, shift=1_000_000):
    return [[int(np.floor(scale * float(c))) + shift for c in v] for v in vectors]


def exact_covariance(x):
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    return [[Fraction(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x), n ** 3)
             for j in range(d)] for i in range(d)], s


def test_covariance_is_exact_and_deviation_too(spark):
    v = sample(300, 9)
    df = frame(spark, v + v[:5])
    x = integers(v + v[:5])
    cov, s = exact_covariance(x)
    model = Z.fit(df, "embedding")
    assert model.n == 305 and model.sums == s
    want = np.array([[float(c) for c in row] for row in cov])
    centre = [(2 * (t - 305 * 1_000_000) + 305) // 610 for t in s]
    squares = Z.squares_of(df, "embedding", 64.0, np.array(centre, np.int64))
    left = [t - 305 * (1_000_000 + c) for t, c in zip(s, centre)]
    assert (Z.covariance(305, left, squares) == want).all()
    rows = Z.whiten(df, model, "embedding", 4).orderBy("vec_id").collect()
    assert [int(r.deviation) for r in rows] == [
        sum((305 * c - t) ** 2 for c, t in zip(row, s)) for row in x]
    e, u = np.linalg.eigh(want)
    w = (np.array(x, float) - np.array(s, float) / 305) @ u[:, ::-1][:, :4] / np.sqrt(e[::-1][:4])
    got = np.array([r.whitened for r in rows])
    assert np.abs(np.abs(got) - np.abs(w)).max() < 1e-8
    assert np.abs(np.cov(got.T, bias=True) - np.eye(4)).max() < 1e-9
    assert Z.identity_error(df, model, "embedding", 4) < 1e-9
    assert rows[0].k == "z" and rows[0].v == 1


def test_polarisation_keeps_values_that_doubles_would_cancel(spark):
    v = [[2.0 ** 30 + i % 3, float(i % 5)] for i in range(60)]
    x = integers([[float(np.float32(c)) for c in r] for r in v])
    cov, _ = exact_covariance(x)
    model = Z.fit(frame(spark, v), "embedding")
    assert model.trace == float(cov[0][0] + cov[1][1])


def test_large_values_use_python_integers(spark):
    v = [[1e30, 1.0, -1e30], [-1e30, 2.0, 5.0], [7.0, 3.0, 1e9], [1.0, 2.0, 3.0]]
    model = Z.fit(frame(spark, v), "embedding")
    limit = 2 ** 40
    x = [[limit, 64, -limit], [-limit, 128, 320],
         [448, 192, 64 * 10 ** 9], [64, 128, 192]]
    x = [[c + 1_000_000 for c in r] for r in x]
    cov, s = exact_covariance(x)
    assert model.sums == s and model.trace == float(sum(cov[i][i] for i in range(3)))
    rows = Z.whiten(frame(spark, v), model, "embedding").orderBy("vec_id").collect()
    assert [int(r.deviation) for r in rows] == [
        sum((4 * c - t) ** 2 for c, t in zip(r, s)) for r in x]


def test_left_out_rows_and_flat_data(spark):
    nan, inf = float("nan"), float("inf")
    v = [[1.0, 2.0], [2.0, 1.0], [0.0, 5.0], None, [None, 1.0], [nan, 0.0], [inf, 0.0], [], [1.0]]
    model = Z.fit(frame(spark, v), "embedding")
    assert model.n == 3 and model.dimension == 2
    rows = Z.whiten(frame(spark, v), model, "embedding").collect()
    assert sorted(r.vec_id for r in rows) == [0, 1, 2] and len(rows[0].whitened) == 2
    flat = frame(spark, [[1.0, 2.0, 3.0]] * 4 + [[1.0, 2.0, 4.0]] * 4)
    model = Z.fit(flat, "embedding")
    rows = Z.whiten(flat, model, "embedding").collect()
    assert all(r.whitened[1:] == [0.0, 0.0] and abs(r.whitened[0]) == pytest.approx(1)
               for r in rows)
    assert Z.identity_error(flat, model, "embedding") == pytest.approx(0)
    for rows in ([], [None, []], [[4.0, 4.0]]):
        df = frame(spark, rows)
        model = Z.fit(df, "embedding")
        assert model.n == (1 if rows == [[4.0, 4.0]] else 0)
        assert Z.whiten(df, model, "embedding").count() == model.n
        assert Z.identity_error(df, model, "embedding") == 0.0
