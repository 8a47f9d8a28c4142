"""One pass over many cutoffs and many group levels equals asking for each."""

import dataclasses
import datetime as dt

from planscore.operators.actuals import program_actuals
from planscore.operators.grouping import (selected_value_states, selected_values,
                                          selected_values_levels)
from planscore.operators.rollup import program_actuals_at_cutoffs
from planscore.params import FIXTURE_RULES as R
from planscore.params import ReportParams
from planscore.streaming.actuals_rollup import actuals_rollup
from tests.conftest import WI_SCHEMA, frame, work_item

P = ReportParams()


def test_all_cutoffs_equal_each_cutoff(spark):
    items = []
    for i, program in enumerate(["Brand#1", "Brand#10", "Brand#9", "Brand#11"] * 6):
        day = dt.date(1998, 1, 10) + dt.timedelta(days=13 * i)
        items.append(work_item(
            program=program, units=float(i) if i % 5 else None, initiation_out=day,
            design_out=None if i % 3 else day, execute_out=day, report_date=dt.date(1998, 6, 1)
            if i % 2 else dt.date(1997, 6, 1), reporting_year=1998 if i % 4 else 1999,
            click_end_date=day + dt.timedelta(days=70) if i % 7 else None))
    wi = frame(spark, items, WI_SCHEMA)
    cutoffs = [dt.date(1997, 1, 1), *[dt.date(1998, m, 15) for m in range(1, 13)],
               dt.date(1998, 3, 15)]
    got = program_actuals_at_cutoffs(actuals_rollup(wi, P, R), cutoffs, R).collect()
    want = []
    for c in sorted(set(cutoffs)):
        p = dataclasses.replace(P, actuals_date=c)
        want += [(c, *r) for r in program_actuals(wi, p, R).collect()]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want)) and len(want) > 30


def test_all_levels_equal_each_level(spark):
    rows = [(a, b, v) for a in ("x", "y", None) for b in ("p", "q")
            for v in ((1.0, 1.0) if a == "x" else (2.0, None) if b == "p" else (None, None))]
    rows += [("x", "p", 1.0), ("z", "r", 5.0)]
    df = spark.createDataFrame(rows, "a string, b string, v double")
    levels = [["a", "b"], ["b"], ["a"], []]
    got = selected_values_levels(selected_value_states(df, ["a", "b"], ["v"]), ["a", "b"], ["v"],
                                 levels).collect()
    want = []
    for level in levels:
        bits = sum(1 << (1 - i) for i, k in enumerate(("a", "b")) if k not in level)
        one = df.selectExpr("*", *[f"{k} AS key_{k}" for k in level])
        sel = selected_values(one, [f"key_{k}" for k in level], ["a", "b", "v"])
        want += [(bits, r.a, r.b, r.v) for r in sel.collect()]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_levels_merge_states_above_one_scan(spark):
    df = spark.range(100).selectExpr("id % 3 AS a", "id % 5 AS b", "id AS v")
    plan = selected_values_levels(selected_value_states(df, ["a", "b"], ["v"]), ["a", "b"], ["v"],
                                  [["a", "b"], ["a"], []])._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("Range (") == 1
    # the rows are aggregated before they are expanded to levels
    assert plan.index("Expand") < plan.index("Range (")
    assert "HashAggregate" in plan[plan.index("Expand"):plan.index("Range (")]
