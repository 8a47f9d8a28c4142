"""Dates with a time of day, NULL semantics, lazy building, number formats, the gate's default."""

import dataclasses
import datetime as dt
import math
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from planscore.functions import bi
from planscore.operators import actuals as A
from planscore.operators import filters as FL
from planscore.params import FIXTURE_RULES as R
from planscore.params import ReportParams
from planscore.plans.gate import gated_scorecard
from planscore.registry import QUERIES, inputs
from planscore.session import checkpoint_dir, drop_materialized, materialize
from planscore.sources.sinks import report_number_text
from planscore.streaming.actuals_rollup import actuals_rollup, program_actuals_from_rollup
from tests.conftest import WI_SCHEMA, frame, work_item

SF = "/root/testdata/sf0.001"
P = ReportParams()


def test_schedule_window_counts_the_last_day_at_any_time(spark):
    schema = WI_SCHEMA.replace("click_end_date date", "click_end_date timestamp")
    last = dt.datetime(1998, 11, 23, 15)
    rows = [work_item(click_end_date=last, report_date=None, schedule_actuals=5.0),
            work_item(click_end_date=last + dt.timedelta(days=1), report_date=None,
                      schedule_actuals=7.0)]
    wi = frame(spark, rows, schema)
    assert A.program_actuals(wi, P, R).first().schedule_actuals == 5.0
    roll = program_actuals_from_rollup(actuals_rollup(wi, P, R), P, R)
    assert roll.first().schedule_actuals == 5.0


def test_rollup_counts_null_reporting_years_like_the_direct_form(spark):
    rows = [work_item(program=p, reporting_year=None) for p in ("Brand#1", "Brand#10")]
    wi = frame(spark, rows, WI_SCHEMA)
    direct = sorted(map(str, A.program_actuals(wi, P, R).collect()))
    assert direct == sorted(map(str, program_actuals_from_rollup(
        actuals_rollup(wi, P, R), P, R).collect()))


def test_not_in_drops_null_programs(spark):
    wi = frame(spark, [work_item(program=p) for p in (None, "Brand#1", "Brand#10")], WI_SCHEMA)
    got = FL.cohort_anti(wi, FL.cohort_table(spark, R.reference_cohort)).collect()
    assert [r.program for r in got] == ["Brand#10"]


@pytest.mark.parametrize("value, text", [
    (0.0005, "0.0005"), (1e7, "10000000"), (12345678.0, "12345678"), (0.0, "0"), (100.0, "100"),
    (6.98600378787879, "6.98600378787879"), (10.8564393939394, "10.8564393939394"),
    (8.43806818181818, "8.43806818181818"), (0.1 + 0.2, "0.3"), (-1 / 3, "-0.333333333333333"),
    (2 / 3e5, "0.00000666666666666667"), (1.0000000000000002, "1"), (float("nan"), "NaN"),
    (-2.5, "-2.5"), (-0.0, "0"), (None, None), (1234.5, "1234.5"), (1e15, "1000000000000000")])
def test_report_numbers_are_plain_decimals(spark, value, text):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(report_number_text(F.col("x"))).first()[0] == text


def test_report_numbers_are_formatted_once(spark):
    """Each number's 15 digits as the exact value rounds to them, halves, signs and sizes included,
    from at most one formatting of the number (it was formatted again for every part of the text)."""
    r = random.Random(3)
    values = [s * r.uniform(1, 10) * 10.0 ** r.randint(-7, 14) for s in (1, -1) for _ in range(1500)]
    values += [r.randint(10 ** 14, 10 ** 15 - 1) + r.choice((0.5, 0.25, 0.75)) for _ in range(300)]
    values += [float((Decimal(r.randint(10 ** 14, 10 ** 15 - 1)) + Decimal("0.5")).scaleb(-k))
               for k in range(19) for _ in range(60)]
    edges = [d * 10.0 ** e for e in range(-7, 15) for d in (1.0, 9.999999999999999, 5.0)]
    values += edges + [math.nextafter(x, y) for x in edges for y in (0.0, math.inf)]

    def plain(x):
        text = format(Decimal(f"{x:.14e}"), "f")
        return text.rstrip("0").rstrip(".") if "." in text else text
    df = spark.createDataFrame([(x,) for x in values], "x double").select(
        "x", report_number_text(F.col("x")).alias("t"))
    assert [(q.x, q.t) for q in df.collect() if q.t != plain(q.x)] == []
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("format_number") <= 2       # halves; numbers of any size


def test_building_a_query_starts_no_job_and_writes_no_file(spark):
    """All report queries but the gates (which decide first, on the calendar alone), the stream
    and the sink (whose result is a written file)."""
    def files():
        return {f for d, _, names in os.walk(checkpoint_dir(spark).removeprefix("file://"))
                for f in (os.path.join(d, n) for n in names)}
    gates = {"gated_report", "scorecard_v6", "scorecard_v6_week_gate"}
    writers = {"program_actuals_streamed", "sink_tsv_roundtrip"}
    spark.range(1).count()
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    for group, names, most in (("build-lazy", set(QUERIES) - gates - writers, 0),
                               ("build-gates", gates, 12)):
        before = files()
        sc.setJobGroup(group, group)
        for name in sorted(names):
            E.queries()[name](spark, SF)
        jobs = [j for j in tracker.getJobIdsForGroup(group) if any(
            tracker.getStageInfo(s).numTasks for s in tracker.getJobInfo(j).stageIds
            if tracker.getStageInfo(s) and "parquet" not in tracker.getStageInfo(s).name)]
        sc.setJobGroup("after", "after")
        assert len(jobs) <= most, (group, len(jobs))
        assert files() == before


def test_gate_defaults_to_today(spark):
    cal = spark.createDataFrame([(dt.date(1990, 1, 1), 1990, 1, 1, "01-1990", True)],
                                "calendar_date date, calendar_year int, calendar_month int, "
                                "calendar_week int, month_year_text string, is_business_day boolean")
    p = dataclasses.replace(P, as_of=None, actuals_date=None)
    assert gated_scorecard(inputs(spark, SF), cal, p, R).count() == 0
    today = spark.sql("select current_date() d").first().d
    cal = spark.createDataFrame([(today, today.year, today.month, 1, "", True)], cal.schema)
    assert "program" in gated_scorecard(inputs(spark, SF), cal, p, R, business_day=1).columns
    df = spark.range(1).select(bi.period_bucket(F.current_date(), p.today()).alias("b"))
    assert df.first().b == "This Month"


def test_written_tables_can_be_dropped(spark):
    df = materialize(spark.range(3), "drop-me")
    assert df.count() == 3
    assert drop_materialized(spark) >= 1
    with pytest.raises(Exception):
        spark.read.parquet(df.inputFiles()[0]).count()


def test_year_prunes_the_rebaseline_scan(spark):
    plan = E.queries()["rebaseline_by_nickname"](spark, SF)._jdf.queryExecution() \
        .executedPlan().toString()
    scans = [x for x in plan.splitlines() if "o_orderdate" in x and "PushedFilters" in x]
    assert scans and all("GreaterThanOrEqual(o_orderdate" in x for x in scans)
