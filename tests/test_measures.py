"""Measure rules on hand-made rows: golden-report cases (re-created) and the semantic traps."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from planscore.functions import measures as M
from planscore.params import FIXTURE_RULES as R
from planscore.params import ReportParams

P = ReportParams()
P_UNIT = dataclasses.replace(P, rag_min=1.0, rag_max=1.0)


def evaluate(spark, rows, *cols):
    df = spark.createDataFrame(rows, "program string, phase string, raw double, actual double")
    return [tuple(r) for r in df.select(*cols).collect()]


# (raw target, actual, pct v1, pct v2, rag v1 at (.995, 1.25), rag at (1, 1))
GOLDEN = [
    (1051.0, 997.0, 0.9486, 0.9486, "RED", "RED"),
    (838.0, 971.0, 1.1587, 1.1587, "GREEN", "RED"),
    (884.0, 1139.0, 1.2885, 1.2885, "RED", "RED"),
    (0.0, 0.0, 1.0, 0.0, "GREEN", "GREEN"),
    (69150.0, 69095.0, 0.9992, 0.9992, "GREEN", "GREEN"),
    (102.0, 101.0, 0.9902, 0.9902, "RED", "RED"),
]


@pytest.mark.parametrize("raw,actual,p1,p2,rag1,rag_unit", GOLDEN)
def test_golden_percent_and_rag(spark, raw, actual, p1, p2, rag1, rag_unit):
    raw_c, act_c = F.col("raw"), F.col("actual")
    got = evaluate(spark, [("X", "Initiation", raw, actual)],
                   M.pct_v1(raw_c, act_c), M.pct_v2(raw_c, act_c),
                   M.rag_threshold(raw_c, act_c, P), M.rag_threshold(raw_c, act_c, P_UNIT))
    assert got == [(p1, p2, rag1, rag_unit)]


def test_zero_target_with_actual(spark):
    got = evaluate(spark, [("X", "Design", 0.0, 100.0)],
                   M.pct_v1(F.col("raw"), F.col("actual")), M.pct_v2(F.col("raw"), F.col("actual")))
    assert got == [(1.0, 0.0)]


def test_black_override_only_for_listed_phase(spark):
    rows = [("Brand#12", "Design", 100.0, 500.0), ("Brand#12", "Dependencies", 100.0, 500.0),
            ("Brand#12", "Execute", 100.0, 500.0), ("Brand#50 X", "Design", 100.0, 500.0)]
    black = M.black_override(F.col("phase"), F.col("program"), R)
    got = evaluate(spark, rows, M.rag_threshold(F.col("raw"), F.col("actual"), P, black))
    assert got == [("BLACK",), ("BLACK",), ("RED",), ("RED",)]


def test_fractional_program_rounding(spark):
    # ~5.49 target, 6.98600378787879 actual: plan 5 (v1) or 5.49 (v3+), percent on 2-dec actual.
    rows = [("Brand#9", "Initiation", 5.49, 6.98600378787879)]
    raw, act, prog = F.col("raw"), F.col("actual"), F.col("program")
    got = evaluate(spark, rows, M.plan_v1(raw), M.plan_v3(raw, prog, R),
                   M.completions_v4(act, prog, R), M.pct_v2(raw, act), M.pct_v4(raw, act, prog, R))
    assert got == [(5.0, 5.49, 6.99, 1.2725, 1.2732)]


def test_missing_actual_counts_zero(spark):
    raw, act = F.col("raw"), F.col("actual")
    got = evaluate(spark, [("X", "Execute", 10.0, None)],
                   M.completions_v1(act), M.pct_v1(raw, act), M.pct_v2(raw, act),
                   M.rag_threshold(raw, act, P))
    assert got == [(0.0, 0.0, 0.0, "RED")]


def test_null_ratio_is_green(spark):
    # Zero target: no ratio, falls through to GREEN (no division error).
    got = evaluate(spark, [("X", "Initiation", 0.0, 5.0), ("X", "Initiation", None, None)],
                   M.rag_threshold(F.col("raw"), F.col("actual"), P))
    assert got == [("GREEN",), ("GREEN",)]


def test_negative_target_falls_through_to_ratio(spark):
    raw, act = F.col("raw"), F.col("actual")
    got = evaluate(spark, [("X", "Initiation", -4.0, 2.0), ("X", "Initiation", -4.0, None)],
                   M.pct_v1(raw, act))
    assert got == [(-0.5,), (None,)]


def test_ratio_rounded_before_threshold(spark):
    # 0.9951 rounds to 1.00 (GREEN); 1.2549 rounds to 1.25 (not above max).
    got = evaluate(spark, [("X", "Initiation", 10000.0, 9951.0), ("X", "Initiation", 10000.0, 12549.0)],
                   M.rag_threshold(F.col("raw"), F.col("actual"), P))
    assert got == [("GREEN",), ("GREEN",)]


def test_param_echo(spark):
    from planscore.params import param_echo
    import datetime as dt
    r = param_echo(spark, P).collect()
    assert [tuple(x) for x in r] == [(38, dt.date(1998, 9, 28), 0.995, 1.25)]


def test_procedure_defaults_are_the_truncated_parameters():
    p = ReportParams.procedure_defaults()
    assert (p.rag_min, p.rag_max, p.output) == (1.0, 1.0, "P")
    r = ReportParams.reference_defaults()
    assert (r.rag_min, r.rag_max, r.output, r.year, r.week) == (0.995, 1.25, "PDC", 2024, 38)
