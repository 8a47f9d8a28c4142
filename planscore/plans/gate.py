"""Gated report (J4 / report v6): the scorecard only on the n-th business day of the month."""

from __future__ import annotations

from pyspark.sql import DataFrame

from planscore.operators.calendar import business_day_gate, business_day_of_week_gate, gated
from planscore.params import ProgramRules, ReportParams
from planscore.plans.scorecard import ScorecardInputs, scorecard


def run_gate(calendar: DataFrame, today, business_day: int = 5, per: str = "month") -> DataFrame:
    """The gate's subquery: ``per="month"`` (n-th business day of the month, the procedure's
    gate) or ``per="week"`` (n-th business day of the calendar week, its alternative)."""
    if per == "month":
        return business_day_gate(calendar, today, business_day)
    if per == "week":
        return business_day_of_week_gate(calendar, today, business_day)
    raise ValueError(f"unknown gate period {per!r}")


def gated_scorecard(inputs: ScorecardInputs, calendar: DataFrame, params: ReportParams,
                    rules: ProgramRules, business_day: int = 5, version: str = "v6",
                    decide_first: bool = True, per: str = "month") -> DataFrame:
    """Empty (same schema) unless ``params.as_of`` (default: today) is the n-th business day of
    its month. The
    cutoff defaults to ``as_of`` when ``actuals_date`` is None.

    By default the gate (a calendar-sized job) is decided before the report is planned, as the
    procedure's ``IF EXISTS ... BEGIN ... END`` does: a closed gate returns an empty local frame
    and reads no facts. ``decide_first=False`` keeps the gate inside one lazy plan (an
    uncorrelated EXISTS); Spark then still runs the report and filters it out."""
    today = params.today()
    report = scorecard(inputs, params, rules, "v4" if version == "v6" else version)
    gate = run_gate(calendar, today, business_day, per)
    if not decide_first:
        return gated(report, gate)
    if gate.isEmpty():
        return report.sparkSession.createDataFrame([], report.schema)
    return report
