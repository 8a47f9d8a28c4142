"""Scorecard on hand-made inputs: multiplicities, missing sides, NULL logic, version rules, and
one-pass plan == nine-block union form."""

import dataclasses
import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from planscore.operators.actuals import (notification_actuals, program_actuals,
                                         program_actuals_two_level)
from planscore.operators.targets import rebaselines, rebaselines_inner_distinct
from planscore.params import FIXTURE_RULES as R
from planscore.params import ReportParams
from planscore.plans.scorecard import (OUTPUT_COLUMNS, ScorecardInputs, scorecard,
                                       scorecard_union_form)
from tests.conftest import UF_SCHEMA, WI_SCHEMA, WT_SCHEMA, frame, target, work_item

P = ReportParams()


def make_inputs(spark, wi, wt, uf=()):
    return ScorecardInputs(frame(spark, wi, WI_SCHEMA), frame(spark, wt, WT_SCHEMA),
                           frame(spark, list(uf), UF_SCHEMA))


def same_multiset(a, b):
    ra, rb = Counter(map(tuple, a.collect())), Counter(map(tuple, b.collect()))
    assert ra == rb
    return list(ra.elements()), list(rb.elements())


def rows_of(df, phase=None, program=None):
    if phase:
        df = df.filter(F.col("phase") == phase)
    if program:
        df = df.filter(F.col("program") == program)
    return df.collect()


@pytest.fixture(scope="module")
def basic(spark):
    wi = [work_item("Brand#10", 3.0, notification=1),
          work_item("Brand#10", 4.0, notification=2),
          work_item("Brand#11", 5.0),
          work_item("Brand#4", 2.0, sub_program="STANDARD")]
    wt = [target("Brand#10", ytd=10.0), target("Brand#10", week=42, month=10, ytd=12.0),
          target("Brand#12", ytd=8.0),                       # targets only
          target("Brand#4", ytd=6.0, nickname="Brand#4 PROMO", ytd_completions=1.5),
          target("Brand#4", ytd=1.0, nickname="Brand#4 STANDARD")]
    uf = [dict(nickname="Brand#10", date_range="Wk 3 1998", rebaseline=7.0),
          dict(nickname="M Brand#1 A", date_range="Wk 3 1998", rebaseline=1.0),
          dict(nickname="Brand#11", date_range="Wk 3 1997", rebaseline=9.0)]
    return make_inputs(spark, wi, wt, uf)


def test_output_schema(spark, basic):
    df = scorecard(basic, P, R, "v4")
    assert tuple(df.columns) == OUTPUT_COLUMNS
    types = dict(df.dtypes)
    assert types["plan"] == types["completions"] == types["pct_to_plan"] == "double"


def test_program_only_in_targets_has_null_owner(spark, basic):
    rows = rows_of(scorecard(basic, P, R, "v1"), "Initiation", "Brand#12")
    assert len(rows) == 1
    r = rows[0]
    assert r.owner is None and r.mega_process is None
    assert (r.plan, r.completions, r.pct_to_plan, r.rag) == (8.0, 0.0, 0.0, "RED")


def test_program_only_in_actuals_is_absent(spark, basic):
    assert rows_of(scorecard(basic, P, R, "v1"), program="Brand#11") == []


def test_external_completions_added_to_execute(spark, basic):
    r = rows_of(scorecard(basic, P, R, "v1"), "Execute", "Brand#4")
    assert [x.completions for x in r] == [2.0 + 1.5]
    assert [x.plan for x in r] == [7.0]


def test_rebaseline_rows(spark, basic):
    r = rows_of(scorecard(basic, P, R, "v1"), "Rebaseline")
    # Brand#10 kept; "M Brand#1 A" maps to Brand#1 which has no targets; 1997 label dropped.
    assert [(x.program, x.plan, x.completions, x.rag) for x in r] == [("Brand#10", 0.0, 7.0, "GRAY")]


def test_schedule_uses_lookahead_week(spark, basic):
    r = rows_of(scorecard(basic, P, R, "v1"), "Schedule", "Brand#10")
    assert [(x.plan, x.completions) for x in r] == [(12.0, 7.0)]


def test_informational_rows(spark, basic):
    for phase in ("Total in WP", "EOY Forecast"):
        r = rows_of(scorecard(basic, P, R, "v1"), phase, "Brand#10")[0]
        assert (r.plan, r.completions, r.pct_to_plan, r.rag) == (0.0, 7.0, 0.0, "GRAY")
    r = rows_of(scorecard(basic, P, R, "v1"), "Total in WP", "Brand#12")[0]
    assert r.completions is None        # not coalesced
    r = rows_of(scorecard(basic, P, R, "v1"), "Annual Target", "Brand#10")[0]
    assert (r.plan, r.completions, r.pct_to_plan, r.rag) == (10.0, 0.0, 0.0, "")


def test_phase_rag_blank_after_v1(spark, basic):
    for v in ("v2", "v3", "v4"):
        rags = {r.rag for r in rows_of(scorecard(basic, P, R, v), "Initiation")}
        assert rags == {""}


def test_missing_external_row_gives_zero_execute(spark):
    # The external program's target rows carry no external nickname: x + NULL = NULL -> 0.
    inp = make_inputs(spark, [work_item("Brand#4", 5.0)], [target("Brand#4", ytd=4.0)])
    r = rows_of(scorecard(inp, P, R, "v1"), "Execute", "Brand#4")
    assert [(x.completions, x.pct_to_plan) for x in r] == [(0.0, 0.0)]


def test_week_spanning_two_months_multiplies_rows(spark):
    wt = [target("Brand#10", week=40, month=9, ytd=5.0), target("Brand#10", week=40, month=10, ytd=6.0),
          target("Brand#13", week=40, month=9, ytd=5.0), target("Brand#13", week=40, month=10, ytd=6.0)]
    inp = make_inputs(spark, [work_item("Brand#10", 3.0)], wt)
    p40 = dataclasses.replace(P, week=40)
    sc = scorecard(inp, p40, R, "v1")
    counts = {(r.program, r.phase): r["count"] for r in sc.groupBy("program", "phase").count().collect()}
    assert counts[("Brand#10", "Initiation")] == 2
    assert counts[("Brand#10", "Execute")] == 4          # m x m with actuals
    assert counts[("Brand#13", "Execute")] == 2          # m without actuals
    assert ("Brand#10", "Schedule") not in counts        # week 44 has no rows


def test_null_user_status_and_cancel_exemption(spark):
    wi = [work_item("Brand#10", 1.0, user_status=None),
          work_item("Brand#10", 2.0, user_status="RDY CNCL"),
          work_item("Brand#10", 4.0, user_status="WIP"),
          work_item("Brand#5", 8.0, user_status=None),
          work_item("Brand#5", 16.0, user_status="RDY CNCL")]
    acts = {r.program: r.initiation_actuals
            for r in program_actuals(frame(spark, wi, WI_SCHEMA), P, R).collect()}
    assert acts == {"Brand#10": 4.0, "Brand#5": 24.0}


def test_null_sub_program_not_executed(spark):
    wi = [work_item("Brand#10", 1.0, sub_program=None), work_item("Brand#10", 2.0, sub_program="PROMO"),
          work_item("Brand#10", 4.0)]
    r = program_actuals(frame(spark, wi, WI_SCHEMA), P, R).collect()[0]
    assert r.execute_actuals_without_external == 4.0


def test_cutoff_sum_without_else_is_null(spark):
    late = dt.date(1998, 12, 1)
    wi = [work_item("Brand#10", 1.0, initiation_out=late), work_item("Brand#10", 2.0, initiation_out=None)]
    r = program_actuals(frame(spark, wi, WI_SCHEMA), P, R).collect()[0]
    assert r.initiation_actuals is None
    assert r.total_in_workplan == 3.0


def test_schedule_window_and_cohort(spark):
    far = dt.date(1999, 6, 1)
    wi = [work_item("Brand#10", 1.0, click_end_date=dt.date(1998, 11, 20)),   # within 8 weeks
          work_item("Brand#10", 2.0, click_end_date=far, report_date=dt.date(1998, 5, 1)),
          work_item("Brand#10", 4.0, click_end_date=far, report_date=far),
          work_item("Brand#1", 8.0, click_end_date=far, report_date=far),      # cohort: by reference
          work_item("Brand#1", 16.0, click_end_date=far, status="OPEN")]
    acts = {r.program: r.schedule_actuals
            for r in program_actuals(frame(spark, wi, WI_SCHEMA), P, R).collect()}
    assert acts == {"Brand#10": 3.0, "Brand#1": 8.0}


@pytest.mark.parametrize("version,week", [("v1", 38), ("v2", 38), ("v3", 38), ("v4", 38),
                                          ("v1", 40), ("v4", 40)])
def test_one_pass_equals_union_form(spark, version, week):
    from planscore.registry import inputs
    inp = inputs(spark, "/root/testdata/sf0.001")
    p = dataclasses.replace(P, week=week)
    a, b = scorecard(inp, p, R, version), scorecard_union_form(inp, p, R, version)
    ra, rb = same_multiset(a, b)
    assert len(ra) > 0


def test_collapsed_equals_two_level(spark):
    from planscore.registry import inputs
    wi = inputs(spark, "/root/testdata/sf0.001").work_items
    a = program_actuals(wi, P, R)
    b = program_actuals_two_level(notification_actuals(wi, P, R), P, R)
    same_multiset(a, b)


def test_semi_equals_inner_distinct(spark):
    from planscore.registry import inputs
    inp = inputs(spark, "/root/testdata/sf0.001")
    a = rebaselines(inp.unit_forecast, inp.weekly_targets, P, R)
    b = rebaselines_inner_distinct(inp.unit_forecast, inp.weekly_targets, P, R)
    same_multiset(a, b)


def test_reference_rules_golden_rows(spark):
    """Original program names: the design override list and its never-matching name, the
    maintenance classification, and the zero-target rule of v1."""
    from planscore.params import REFERENCE_RULES
    rules = dataclasses.replace(REFERENCE_RULES, maintenance_owner="M", projects_owner="P")
    p = ReportParams.reference_defaults()
    d = dt.date(2024, 3, 1)
    names = ("COE Expense", "ED WFM Surge Arresters HFTD", "Mobile Home Park Electric", "ED Cable")
    wi = [work_item(n, 7.0, reporting_year=2024, work_plan_date=d, report_date=d, reference_date=d)
          for n in names]
    wt = [target(n, ytd=7.0, nickname=n) for n in names]
    wt.append(target("Zero Program", ytd=0.0, nickname="Zero Program"))
    sc = scorecard(make_inputs(spark, wi, wt), p, rules, "v1")
    got = {(r.program, r.phase): (r.rag, r.pct_to_plan, r.mega_process) for r in sc.collect()}
    assert got[("COE Expense", "Design")] == ("BLACK", 1.0, "ED Maintenance")
    assert got[("ED WFM Surge Arresters HFTD", "Design")] == ("GREEN", 1.0, "ED Projects")
    assert got[("Mobile Home Park Electric", "Dependencies")][0] == "BLACK"
    assert got[("Mobile Home Park Electric", "Design")][0] == "BLACK"
    assert got[("ED Cable", "Design")] == ("GREEN", 1.0, "ED Projects")
    assert got[("Zero Program", "Initiation")] == ("GREEN", 1.0, None)


def test_server_like_collation(spark):
    """With the collation option, names match regardless of case and trailing blanks."""
    from planscore.functions.collation import SERVER_LIKE
    wi = [work_item("brand#5 ", 8.0, user_status="rdy cncl"),        # exempt program, any case
          work_item("Brand#10", 2.0, user_status="Rdy Cncl"),        # cancelled, any case
          work_item("Brand#10", 3.0)]
    wt = [target("BRAND#5", ytd=8.0), target("brand#10", ytd=3.0)]
    inp = make_inputs(spark, wi, wt)
    plain = {(r.program, r.phase): r.completions for r in scorecard(inp, P, R, "v1").collect()}
    assert plain[("BRAND#5", "Initiation")] == 0.0          # binary: no match
    coll = dataclasses.replace(R, collation=SERVER_LIKE)
    sc = scorecard(inp, P, coll, "v1")
    assert all(t == "string" for c, t in sc.dtypes if c not in ("plan", "completions", "pct_to_plan"))
    got = {(r.program, r.phase): r.completions for r in sc.collect()}
    assert got[("BRAND#5", "Initiation")] == 8.0
    assert got[("brand#10", "Initiation")] == 3.0
