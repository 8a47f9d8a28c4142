import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from planscore.session import build_session  # noqa: E402

WI_SCHEMA = ("program string, sub_program string, notification long, work_order int, mat int, "
             "region string, division string, funding_action string, reporting_year int, "
             "work_plan_date date, report_date date, reference_date date, status string, "
             "user_status string, initiation_out date, design_out date, dependency_out date, "
             "schedule_out date, click_end_date date, execute_out date, "
             "initiation_actuals double, design_actuals double, dependency_actuals double, "
             "schedule_actuals double, execute_actuals double, in_workplan double")

WT_SCHEMA = ("program string, nickname string, week int, month int, month2 string, "
             "initiation_ytd_target double, design_ytd_target double, "
             "dependency_ytd_target double, execute_ytd_target double, "
             "execute_ytd_forecast double, ytd_completions double")

UF_SCHEMA = "nickname string, date_range string, rebaseline double"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", "planscore-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s


def work_item(program="Brand#10", units=1.0, **kw):
    """One work-item row with in-year, pre-cutoff defaults (year 1998, cutoff 1998-09-28)."""
    d = dt.date(1998, 3, 1)
    row = dict(program=program, sub_program="STANDARD", notification=1, work_order=1, mat=1,
               region="R", division="D", funding_action="F", reporting_year=1998,
               work_plan_date=d, report_date=d, reference_date=d, status="COMP",
               user_status="WIP", initiation_out=d, design_out=d, dependency_out=d,
               schedule_out=d, click_end_date=d, execute_out=d, initiation_actuals=units,
               design_actuals=units, dependency_actuals=units, schedule_actuals=units,
               execute_actuals=units, in_workplan=units)
    row.update(kw)
    return row


def target(program="Brand#10", week=38, month=9, ytd=10.0, nickname=None, **kw):
    row = dict(program=program, nickname=nickname or f"{program} STANDARD", week=week,
               month=month, month2=f"M{month}", initiation_ytd_target=ytd,
               design_ytd_target=ytd, dependency_ytd_target=ytd, execute_ytd_target=ytd,
               execute_ytd_forecast=ytd, ytd_completions=ytd)
    row.update(kw)
    return row


def frame(spark, rows, schema):
    cols = [c.strip().split(" ")[0] for c in schema.split(",")]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], schema)
