"""The incremental rollup gives the report's program actuals at any cutoff, and the streamed
rollup equals the batch one."""

import dataclasses
import datetime as dt
import uuid
from collections import Counter

import pytest

from planscore.operators.actuals import program_actuals
from planscore.params import FIXTURE_RULES as R
from planscore.params import ReportParams
from planscore.plans.scorecard import ScorecardInputs, scorecard
from planscore.registry import inputs, tables
from planscore.session import checkpoint_dir
from planscore.sources import fixtures as fx
from planscore.streaming.actuals_rollup import (actuals_rollup, program_actuals_from_rollup,
                                                read_rollup, start_rollup_stream)
from tests.conftest import WI_SCHEMA, frame, work_item

P = ReportParams()
SF = "/root/testdata/sf0.001"


def bag(df):
    return Counter(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect())


@pytest.mark.parametrize("cutoff", [dt.date(1998, 1, 15), dt.date(1998, 9, 28), dt.date(1999, 3, 1)])
def test_rollup_equals_direct(spark, cutoff):
    p = dataclasses.replace(P, actuals_date=cutoff)
    wi = fx.work_items(tables(spark, SF))
    rollup = actuals_rollup(wi, p, R)
    assert bag(program_actuals_from_rollup(rollup, p, R)) == bag(program_actuals(wi, p, R))


def test_rollup_schedule_null_and_zero(spark):
    far = dt.date(1999, 6, 1)
    wi = [work_item("Brand#10", None, click_end_date=far, report_date=far),       # dated, out -> 0
          work_item("Brand#11", None, click_end_date=dt.date(1998, 10, 1), report_date=far),  # NULL in
          work_item("Brand#12", None, reporting_year=1997, report_date=dt.date(1998, 2, 1)),  # 0
          work_item("Brand#13", None)]                                              # always, NULL
    df = frame(spark, wi, WI_SCHEMA)
    got = {r.program: r.schedule_actuals for r in
           program_actuals_from_rollup(actuals_rollup(df, P, R), P, R).collect()}
    want = {r.program: r.schedule_actuals for r in program_actuals(df, P, R).collect()}
    assert got == want == {"Brand#10": 0.0, "Brand#11": None, "Brand#12": 0.0, "Brand#13": None}


def test_streamed_rollup_feeds_scorecard(spark):
    t = tables(spark, SF)
    root = f"{checkpoint_dir(spark).rstrip('/')}/test-stream/{uuid.uuid4().hex}"
    li = spark.readStream.schema(t.lineitem.schema).parquet(f"{SF}/lineitem.parque[t]")
    q = start_rollup_stream(fx.work_items(t, li), P, R, f"{root}/rollup", f"{root}/state")
    q.awaitTermination()
    rollup = read_rollup(spark, f"{root}/rollup")
    assert bag(rollup) == bag(actuals_rollup(fx.work_items(t), P, R))
    base = inputs(spark, SF)
    from_rollup = dataclasses.replace(base, work_items=None,
                                      program_actuals=program_actuals_from_rollup(rollup, P, R))
    assert bag(scorecard(from_rollup, P, R, "v4")) == bag(scorecard(base, P, R, "v4"))
    assert isinstance(from_rollup, ScorecardInputs)


def test_rollup_state_survives_restart(spark, tmp_path):
    """Two arrivals of line items, with the query stopped and restarted from its checkpoint in
    between: the restored state plus the new file give the same rollup as one batch run."""
    t = tables(spark, SF)
    src, root = str(tmp_path / "lineitem"), f"{checkpoint_dir(spark).rstrip('/')}/test-restart/{uuid.uuid4().hex}"
    first = t.lineitem.filter("l_orderkey % 2 = 0")
    second = t.lineitem.filter("l_orderkey % 2 = 1")
    first.write.parquet(f"{src}/part=1")

    def run_once():
        li = spark.readStream.schema(t.lineitem.schema).parquet(f"{src}/*")
        q = start_rollup_stream(fx.work_items(t, li), P, R, f"{root}/rollup", f"{root}/state")
        q.awaitTermination()
        assert q.exception() is None
        return q

    run_once()
    partial = bag(read_rollup(spark, f"{root}/rollup"))
    second.write.parquet(f"{src}/part=2")
    q = run_once()
    assert q.lastProgress is not None
    full = bag(read_rollup(spark, f"{root}/rollup"))
    assert full == bag(actuals_rollup(fx.work_items(t), P, R))
    assert partial != full
