"""Registered queries against their DuckDB oracle on the smallest data set (the full set runs
with ``python tools/oracle_check.py``)."""

import pytest

import __spark_entry__ as E
from oracle.compare import compare, duck
from planscore.registry import QUERIES

SF = "/root/testdata/sf0.001"
KEYS = ["notification_actuals", "program_actuals", "weekly_targets", "rebaseline_semi",
        "execute_with_external", "cohort_anti", "nth_business_day_month",
        "first_business_day_week", "selected_value", "variance_color", "labour_kpi",
        "pct_to_plan_v1", "rag_black_override", "scorecard_v1", "scorecard_v1_week40",
        "scorecard_v4", "scorecard_v6", "gated_report", "sink_tsv_roundtrip"]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    ok, msg = compare(E.queries()[key](spark, SF), con, E.oracle_sql()[key])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and len(df.columns) == 12
