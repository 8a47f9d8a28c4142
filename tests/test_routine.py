"""The SQL routine against the DataFrame report, on hand-made inputs with every odd case."""

import dataclasses
import datetime as dt
from collections import Counter

import pytest

from planscore.params import FIXTURE_RULES as R
from planscore.params import ReportParams
from planscore.plans.gate import gated_scorecard
from planscore.plans.routine import register_report_routine
from planscore.plans.scorecard import ScorecardInputs, scorecard, scorecard_union_form
from tests.conftest import UF_SCHEMA, WI_SCHEMA, WT_SCHEMA, frame, target, work_item

P = ReportParams()


def rows(df):
    return Counter(map(tuple, df.select(sorted(df.columns)).collect()))


def odd_inputs(spark):
    d = dt.date(1998, 11, 20)
    wi = [work_item(program=p, units=u, **kw) for p, u, kw in (
        ("Brand#4", 3.0, {}), ("Brand#9", 0.123456789, {}), ("Brand#10", 5.0, dict(execute_out=d)),
        ("Brand#1", 2.0, dict(report_date=d, click_end_date=None)), ("Brand#1", 7.0, {}),
        ("Brand#3", 4.0, dict(status="OPEN")), ("Brand#5", 1.0, dict(user_status="X CNCL")),
        ("Brand#10", 9.0, dict(user_status=None)), ("Brand#11", 1.0, dict(sub_program=None)),
        ("Brand#12", 2.0, dict(reporting_year=1997, initiation_out=None)),
        ("Brand#30", 1.0, {}), (None, 1.0, {}), ("UNTRACKED", 1.0, {}))]
    wt = []
    for p in ("Brand#4", "Brand#9", "Brand#10", "Brand#1", "Brand#3", "Brand#5", "Brand#11",
              "Brand#12", "Brand#20"):
        wt += [target(program=p, month=m, ytd=y) for m, y in ((9, 3.456), (10, 0.0))]
    wt += [target(program="Brand#4", nickname="Brand#4 PROMO", month=9, ytd=2.0),
           target(program="Brand#10", week=42, execute_ytd_forecast=None),
           target(program="Brand#9", week=42, ytd=1.005), target(program="Brand#2", week=3),
           target(program=None), target(program="Brand#13", ytd=None)]
    uf = [dict(nickname=n, date_range=f"Wk 3 {y}", rebaseline=v) for n, y, v in (
        ("M Brand#1 A", 1998, 4.0), ("M Brand#1 B", 1998, 5.0), ("M Brand#1 B", 1997, 50.0),
        ("C Brand#2", 1998, None), ("Brand#9", 1998, 1.239), ("Nobody", 1998, 1.0))]
    return ScorecardInputs(frame(spark, wi, WI_SCHEMA), frame(spark, wt, WT_SCHEMA),
                           frame(spark, uf, UF_SCHEMA))


@pytest.fixture(scope="module")
def own(spark):
    s = spark.newSession()
    s.conf.set("spark.sql.shuffle.partitions", "2")
    return s


@pytest.mark.parametrize("version", ["v1", "v2", "v3", "v4"])
def test_routine_equals_the_report(own, version):
    inputs = odd_inputs(own)
    register_report_routine(own, inputs, R, params=P)
    own.sql(f"SET VAR report_version = '{version}'")
    got = rows(own.sql("SELECT * FROM scorecard"))
    assert got == rows(scorecard(inputs, P, R, version)) and sum(got.values()) > 100
    assert got == rows(scorecard_union_form(inputs, P, R, version))


def test_variables_take_effect_between_queries(own):
    inputs = odd_inputs(own)
    register_report_routine(own, inputs, R, params=P, prefix="my_")
    own.sql("SET VAR report_week = 34")
    own.sql("SET VAR report_rag_max = 1")
    own.sql("SET VAR report_output = 'it''s'")
    p = dataclasses.replace(P, week=34, rag_max=1.0, output="it's")
    assert rows(own.sql("SELECT * FROM my_scorecard")) == rows(scorecard(inputs, p, R, "v4"))
    own.sql("SET VAR report_week = 38")
    own.sql("SET VAR report_cutoff = DATE'1998-12-31'")
    p = dataclasses.replace(p, week=38, actuals_date=dt.date(1998, 12, 31))
    assert rows(own.sql("SELECT * FROM my_scorecard")) == rows(scorecard(inputs, p, R, "v4"))


def test_gate_opens_on_the_business_day_alone(own):
    days = [dt.date(1998, 9, d) for d in range(1, 31)]
    cal = own.createDataFrame(
        [(d, d.year, d.month, d.isocalendar()[1], "", d.weekday() < 5) for d in days],
        "calendar_date date, calendar_year int, calendar_month int, calendar_week int, "
        "month_year_text string, is_business_day boolean")
    inputs = odd_inputs(own)
    assert register_report_routine(own, inputs, R, cal, P) == ["scorecard", "scorecard_gated"]
    own.sql("SET VAR report_cutoff = NULL")
    for day, n in ((dt.date(1998, 9, 7), 5), (dt.date(1998, 9, 8), 5), (dt.date(1998, 9, 8), 6)):
        own.sql(f"SET VAR report_as_of = DATE'{day}'")
        own.sql(f"SET VAR report_business_day = {n}")
        p = dataclasses.replace(P, actuals_date=None, as_of=day)
        got = rows(own.sql("SELECT * FROM scorecard_gated"))
        assert got == rows(gated_scorecard(inputs, cal, p, R, n))
        assert bool(got) == ((day.day, n) in ((7, 5), (8, 6)))


def test_quotes_in_names(own):
    r = dataclasses.replace(R, maintenance_owner="O'Neil \\ Sons", external_nickname="a'b")
    inputs = odd_inputs(own)
    register_report_routine(own, inputs, r, params=P)
    assert rows(own.sql("SELECT * FROM scorecard")) == rows(scorecard(inputs, P, r, "v4"))
