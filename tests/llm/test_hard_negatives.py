"""Hard negatives by Four-Russians scoring against plain Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from planscore.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, q string, anchor string, rid string"


def brute(rows, low=80, high=100, k=5):
    ok = [(i, [math.floor(256 * float(c)) for c in v], y) for i, v, y in rows
          if v is not None and y is not None
          and all(c is not None and math.isfinite(c) for c in v)]

    def ranked(scored):
        return sorted(scored, key=lambda x: (-x[1], x[0] is None, x[0] or 0))[:k]
    out = []
    for at, (i, a, y) in enumerate(ok):
        if i is None or i % 100:
            continue
        s = [(j, sum(p * q for p, q in zip(a, b)), z) for n, (j, b, z) in enumerate(ok) if n != at]
        for j, p, _ in ranked([x for x in s if x[2] == y]):
            hits = [x for x in s if x[2] != y and low * p <= 100 * x[1] <= high * p]
            out += [(i, j, r + 1, x[0], p, x[1]) for r, x in enumerate(ranked(hits))]
    return sorted(out, key=str)


def mined(spark, rows, schema=SCHEMA, **kw):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], schema)
    return sorted([(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score,
                    r.negative_score)
                   for r in H.mine(df, F.col("vec_id") % 100 == 0, **kw).collect()], key=str)


def vectors(n, d, seed, copies=0):
    r = np.random.default_rng(seed)
    v = r.normal(size=(n, d)) / math.sqrt(d)
    v[: copies] = v[0]
    return [[float(np.float32(c)) for c in x] for x in v]


def test_scores_equal_the_inner_products():
    r = np.random.default_rng(1)
    for bound in (3, 200, 40_000, 2 ** 30, 2 ** 62):
        a, c = r.integers(-bound, bound, (7, 16)), r.integers(-bound, bound, (33, 16))
        a[0], c[0] = -bound, bound - 1
        with np.errstate(over="ignore"):
            want = (c[:, None, :] * a[None]).sum(-1)       # modulo 2**64 beyond a long
        assert (H.scores(H.subset_tables(a), H.bit_planes(c)) == want).all()


def test_window_equals_the_inequality():
    for p in (0, 1, 7, 99, 100, 12345, -1, -50, 10 ** 16):
        lo, hi = H.window(np.array([p]), 80, 100)
        for s in {lo[0] - 1, lo[0], hi[0], hi[0] + 1}:
            assert (lo[0] <= s <= hi[0]) == (80 * p <= 100 * int(s) <= 100 * p)


@pytest.mark.parametrize("d", [5, 64])
def test_matches_brute_force_in_many_cells(spark, monkeypatch, d):
    monkeypatch.setattr(H, "CELL_ROWS", 40)
    monkeypatch.setattr(H, "CELL_ANCHORS", 2)
    monkeypatch.setattr(H, "TABLE_ANCHORS", 2)
    monkeypatch.setattr(H, "CHUNK", 16)
    rows = [(25 * i, v, i % 3 if i % 4 else 0) for i, v in enumerate(vectors(160, d, d))]
    assert mined(spark, rows) == brute(rows)


def test_copies_ties_and_repeated_rows(spark):
    v = vectors(60, 8, 3, copies=25)
    rows = [(50 * i, x, i % 2) for i, x in enumerate(v)]
    rows += rows[:4] + [(0, v[0], 1), (None, v[0], 1), (None, v[0], 0)]
    got, want = mined(spark, rows), brute(rows)
    assert got == want and got


def test_nulls_lengths_and_large_entries(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (100, [1.0], 1), (3, [1.5, 1.0, 7.0], 1), (4, [1.0, 1.9], 2),
            (5, None, 1), (6, [None, 1.0], 1), (7, [nan, 1.0], 2), (8, [inf, 1.0], 2),
            (9, [1.0, 1.0], None), (200, [], 2), (10, [], 2), (11, [0.0], 1),
            (300, [1e6, 1e6], 3), (12, [1e6, 9e5], 3), (13, [9e5, 9e5], 4), (400, [-1.0], 7),
            (14, [1.0], 7), (15, [1.0], 8)]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1)]) == []
