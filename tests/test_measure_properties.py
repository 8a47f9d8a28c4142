"""Measure rules against a brute-force Python rendering of the report's CASE expressions, over
generated targets and actuals (NULLs, zeros, negatives, fractional values)."""

import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from planscore.functions import measures as M
from planscore.params import FIXTURE_RULES as R
from planscore.params import ReportParams

P = ReportParams()


def rnd(x, d):
    """Half-up rounding of the shortest decimal form (Spark's ``round``)."""
    if x is None:
        return None
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-d), rounding=ROUND_HALF_UP))


def coalesce0(x):
    return 0.0 if x is None else x


def pct_v1(t, a):
    t0, a0 = coalesce0(t), coalesce0(a)
    if t0 > 0 and a0 == 0:
        return 0.0
    if t0 == 0:
        return 1.0
    return None if a is None else rnd(a / t0, 4)


def pct_v2(t, a):
    return 0.0 if coalesce0(t) == 0 else rnd(coalesce0(a) / t, 4)


def pct_v4(t, a, frac):
    a0 = rnd(coalesce0(a), 2) if frac else coalesce0(a)
    return 0.0 if coalesce0(t) == 0 else rnd(a0 / t, 4)


def rag(t, a):
    t0 = coalesce0(t)
    r = None if t0 == 0 else rnd(coalesce0(a) / t0, 2)
    if r is not None and r > P.rag_max:
        return "RED"
    if r is not None and r < P.rag_min:
        return "RED"
    return "GREEN"


def cases(n=400, seed=7):
    g = random.Random(seed)
    pool_t = [None, 0.0, -4.0, 1.0, 8.0, 200.0, 1000.0]
    pool_a = [None, 0.0, 1.0, 199.0, 201.0, 995.0, 1250.0, 1255.0]
    out = [(t, a) for t in pool_t for a in pool_a]
    while len(out) < n:
        t = g.choice([float(g.randint(1, 5000)), g.randint(1, 4000) * 0.125])
        a = g.choice([None, float(g.randint(0, 6000)), g.randint(0, 6000) * 0.125,
                      round(t * g.uniform(0.9, 1.3), 3)])
        out.append((t, a))
    return out


def test_rules_match_brute_force(spark):
    rows = [(("Brand#9" if i % 3 == 0 else "Brand#10"), t, a) for i, (t, a) in enumerate(cases())]
    df = spark.createDataFrame(rows, "program string, raw double, actual double")
    raw, act, prog = F.col("raw"), F.col("actual"), F.col("program")
    got = df.select("program", "raw", "actual", M.pct_v1(raw, act).alias("p1"),
                    M.pct_v2(raw, act).alias("p2"), M.pct_v4(raw, act, prog, R).alias("p4"),
                    M.rag_threshold(raw, act, P).alias("rag")).collect()
    bad = []
    for r in got:
        want = (pct_v1(r.raw, r.actual), pct_v2(r.raw, r.actual),
                pct_v4(r.raw, r.actual, r.program == "Brand#9"), rag(r.raw, r.actual))
        if (r.p1, r.p2, r.p4, r.rag) != want:
            bad.append((r.program, r.raw, r.actual, (r.p1, r.p2, r.p4, r.rag), want))
    assert not bad, bad[:5]
    assert len(got) == 400
