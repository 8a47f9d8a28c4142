"""Named queries over one data directory: every operator of the report as a runnable DataFrame.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole tables of that
directory. Parameters are the report defaults on the fixture calendar (year 1998, week 38,
cutoff 1998-09-28) unless the name says otherwise.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planscore.functions import bi
from planscore.functions import measures as M
from planscore.operators import actuals as A
from planscore.operators import calendar as C
from planscore.operators import filters as FL
from planscore.operators import targets as TG
from planscore.operators.grouping import selected_values
from planscore.operators.rollup import program_actuals_at_cutoffs
from planscore.params import FIXTURE_RULES, ReportParams
from planscore.plans import finance, labour
from planscore.plans.gate import gated_scorecard
from planscore.plans.routine import register_report_routine
from planscore.plans.scorecard import (ScorecardInputs, joined_phase_rows, phase_rows, scorecard,
                                       scorecard_union_form)
from planscore.session import checkpoint_dir, default_parallelism, ensure_conf
from planscore.streaming.actuals_rollup import (actuals_rollup, program_actuals_from_rollup,
                                                read_rollup, start_rollup_stream)
from planscore.sources import fixtures as fx
from planscore.sources.sinks import report_number_text, tsv_roundtrip
from planscore.sources.tables import Tables

R = FIXTURE_RULES
P = ReportParams()
P_WEEK40 = dataclasses.replace(P, week=40)
P_UNIT_THRESHOLDS = dataclasses.replace(P, rag_min=1.0, rag_max=1.0)
P_V5 = dataclasses.replace(P, actuals_date=None, as_of=dt.date(1998, 8, 24))
GATE_ON = dt.date(1998, 9, 7)     # 5th business day of September 1998
GATE_OFF = dt.date(1998, 9, 8)
P_V6_ON = dataclasses.replace(P, actuals_date=None, as_of=GATE_ON)
P_V6_OFF = dataclasses.replace(P, actuals_date=None, as_of=GATE_OFF)
WEEK_GATE_ON = dt.date(1998, 9, 14)   # Monday: 1st business day of ISO week 38
P_WEEK_GATE = dataclasses.replace(P, actuals_date=None, as_of=WEEK_GATE_ON)
LABOUR_TODAY = dt.date(2024, 1, 15)
CALENDAR_TODAY = dt.date(1995, 6, 15)   # inside the calendar: months before, of and after it

WEEK_ENDS = [dt.date(1998, 1, 4) + dt.timedelta(weeks=w) for w in range(52)]   # Sundays
LEVELS = [["line", "category", "period"], ["category", "period"], ["period"], []]

Query = Callable[[SparkSession, str], DataFrame]


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    ensure_conf(spark)
    return Tables.of(spark, sf_dir)


def inputs(spark: SparkSession, sf_dir: str) -> ScorecardInputs:
    """Report inputs, all lazy: building a query starts no job and writes no file."""
    t = tables(spark, sf_dir)
    return ScorecardInputs(fx.work_items(t), fx.weekly_targets(t, P.year),
                           fx.unit_forecast(t, P.year))


def _wi(s, d):
    return fx.work_items(tables(s, d))


def _wt(s, d):
    return fx.weekly_targets(tables(s, d), P.year)


def _uf(s, d):
    return fx.unit_forecast(tables(s, d))


def _uf_year(s, d):
    return fx.unit_forecast(tables(s, d), P.year)


def _cal(s, d):
    return fx.calendar(tables(s, d))


def _lab(s, d):
    return fx.labour_by_day(tables(s, d))


def _fin(s, d):
    return fx.finance_rows(tables(s, d))


def _acts(s, d, p=P):
    return A.program_actuals(_wi(s, d), p, R)


def _dot(s, d, p=P):
    return TG.targets_at_week(_wt(s, d), p, R)


def _measured(s, d):
    rows = joined_phase_rows(inputs(s, d), P, R)
    return rows.filter(F.col("phase").isin("Initiation", "Design", "Dependencies", "Schedule",
                                           "Execute"))


def _measure_query(expr_fn) -> Query:
    def run(s, d):
        rows = _measured(s, d)
        return rows.select("program", "phase", "plan_raw", "actual",
                           expr_fn(F.col("plan_raw"), F.col("actual"), F.col("program"),
                                   F.col("phase")))
    return run


def _gate_exists_counts(s, d):
    """The gate as EXISTS inside one plan: rows of the weekly targets per month, without a gate, and
    behind a gate on an open and on a closed day."""
    rows = _wt(s, d).select("program", "month")

    def count(name, day):
        kept = rows if day is None else C.gated(rows, C.business_day_gate(_cal(s, d), day))
        return kept.groupBy("month").agg(F.count("*").alias(name))
    return (count("n_rows", None).join(count("n_open", GATE_ON), "month", "left")
            .join(count("n_closed", GATE_OFF), "month", "left").na.fill(0))


def _routine(*statements: str) -> Query:
    """The report as a SQL user runs it: variables set by statements, then a view (in a session of
    its own, which holds the variables and views). Values set from a ``VALUES`` row need no job."""
    def run(s, d):
        own = ensure_conf(s.newSession())
        own.conf.set("spark.sql.shuffle.partitions", s.conf.get("spark.sql.shuffle.partitions"))
        register_report_routine(own, inputs(own, d), R, _cal(own, d), P)
        for statement in statements[:-1]:
            own.sql(statement)
        return own.sql(statements[-1])
    return run


def _in_scope(s, d):
    return _wi(s, d).filter(FL.report_scope(P, R))


def program_actuals_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 through the incremental rollup: line items arrive as a stream (stream-static joins to
    the order, part and customer dimensions), the rollup state is written to the shared
    checkpoint folder, and the program actuals are read from it at the cutoff."""
    own = spark.newSession()    # the state's partition count is a setting of the stream's session
    own.conf.set("spark.sql.shuffle.partitions", str(default_parallelism(spark)))
    t = tables(own, sf_dir)
    root = f"{checkpoint_dir(spark).rstrip('/')}/planscore-stream/{uuid.uuid4().hex}"
    li = (own.readStream.schema(t.lineitem.schema)
          .parquet(f"{t.root}/lineitem.parque[t]"))
    q = start_rollup_stream(fx.work_items(t, li), P, R, f"{root}/rollup", f"{root}/state")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return program_actuals_from_rollup(read_rollup(spark, f"{root}/rollup"), P, R)


QUERIES: dict[str, Query] = {
    # sources (S1-S8, S10)
    "source_work_items": _wi,
    "source_weekly_targets": _wt,
    "source_unit_forecast": _uf,
    "source_finance_rows": _fin,
    "source_labour_by_day": _lab,
    "dim_calendar": _cal,
    "week_lookup_distinct": lambda s, d: fx.week_lookup(tables(s, d), P.year).filter(
        F.col("week") == P.week),
    # filters (F1-F7, F10, F11)
    "filter_tracked": lambda s, d: FL.filter_tracked(_wi(s, d), R),
    "filter_cancelled_exempt": lambda s, d: FL.filter_cancelled_exempt(_wi(s, d), R),
    "filter_year_eligible": lambda s, d: FL.filter_year_eligible(_wi(s, d), P, R),
    "cohort_semi": lambda s, d: FL.cohort_semi(_wi(s, d), FL.cohort_table(s, R.reference_cohort)),
    "cohort_anti": lambda s, d: FL.cohort_anti(_wi(s, d), FL.cohort_table(s, R.reference_cohort)),
    "filter_label_year": lambda s, d: FL.filter_label_year(_uf_year(s, d), P),
    "filter_week": lambda s, d: FL.filter_week(_wt(s, d), P.week),
    "filter_week_lookahead": lambda s, d: FL.filter_week(_wt(s, d), P.lookahead_week()),
    "classify_program": lambda s, d: (
        FL.filter_tracked(_wi(s, d), R).select("program").distinct()
        .select("program", *A.classify(R))),
    "normalize_nickname": lambda s, d: (
        _uf(s, d).select("nickname").distinct()
        .select("nickname", TG.normalize_nickname(F.col("nickname"), R).alias("program"))),
    # aggregations (A1-A5) and joins
    "notification_actuals": lambda s, d: A.notification_actuals(_wi(s, d), P, R),
    "agg_year_gated": lambda s, d: _in_scope(s, d).groupBy("program").agg(
        *[F.sum(A.year_gated(m, P)).alias(m) for m in
          ("initiation_actuals", "design_actuals", "dependency_actuals", "in_workplan")]),
    "agg_schedule_8w": lambda s, d: _in_scope(s, d).groupBy("program").agg(
        F.sum(A.schedule_gated(P, R)).alias("schedule_actuals")),
    "agg_execute_completed": lambda s, d: _in_scope(s, d).groupBy("program").agg(
        F.sum(A.execute_gated(P, R)).alias("execute_actuals")),
    "program_actuals": lambda s, d: _acts(s, d),
    "program_actuals_two_level": lambda s, d: A.program_actuals_two_level(
        A.notification_actuals(_wi(s, d), P, R), P, R),
    "program_actuals_streamed": program_actuals_streamed,
    "program_actuals_by_week": lambda s, d: program_actuals_at_cutoffs(
        actuals_rollup(_wi(s, d), P, R), WEEK_ENDS, R),
    "weekly_targets": lambda s, d: _dot(s, d),
    "nickname_completions": lambda s, d: TG.nickname_completions(_wt(s, d), P, R),
    "schedule_target": lambda s, d: TG.schedule_targets(_wt(s, d), P),
    "rebaseline_by_nickname": lambda s, d: TG.rebaseline_by_nickname(_uf_year(s, d), P, R),
    "rebaseline_semi": lambda s, d: TG.rebaselines(_uf_year(s, d), _wt(s, d), P, R),
    "rebaseline_inner_distinct": lambda s, d: TG.rebaselines_inner_distinct(
        _uf_year(s, d), _wt(s, d), P, R),
    "join_left_plan_actual": lambda s, d: _dot(s, d).join(_acts(s, d), "program", "left"),
    "execute_with_external": lambda s, d: A.execute_with_external(_acts(s, d), _dot(s, d), R),
    # measure rules (M2, M4-M9) over the joined phase rows
    "plan_rounding": _measure_query(
        lambda raw, a, p, ph: M.plan_v3(raw, p, R).alias("plan")),
    "completions_rounding": _measure_query(
        lambda raw, a, p, ph: M.completions_v4(a, p, R).alias("completions")),
    "pct_to_plan_v1": _measure_query(lambda raw, a, p, ph: M.pct_v1(raw, a).alias("pct_to_plan")),
    "pct_to_plan_v2": _measure_query(lambda raw, a, p, ph: M.pct_v2(raw, a).alias("pct_to_plan")),
    "pct_to_plan_v4": _measure_query(
        lambda raw, a, p, ph: M.pct_v4(raw, a, p, R).alias("pct_to_plan")),
    "rag_threshold": _measure_query(
        lambda raw, a, p, ph: M.rag_threshold(raw, a, P).alias("rag")),
    "rag_black_override": _measure_query(
        lambda raw, a, p, ph: M.rag_threshold(raw, a, P, M.black_override(ph, p, R)).alias("rag")),
    # calendar predicate, windows and the gate
    "business_days_in_month": lambda s, d: C.business_days_in_month(_cal(s, d), GATE_ON),
    "nth_business_day_month": lambda s, d: C.nth_business_day_of_month(_cal(s, d), 5),
    "first_business_day_week": lambda s, d: C.nth_business_day_of_week(_cal(s, d), P.year, 1),
    "gate_exists_counts": _gate_exists_counts,
    "gated_report": lambda s, d: gated_scorecard(inputs(s, d), _cal(s, d), P_V6_OFF, R),
    # BI measures
    "selected_value": lambda s, d: selected_values(
        _fin(s, d), ["category", "period"], ["actual", "budget", "variance"]),
    "selected_value_cells": lambda s, d: selected_values(
        _fin(s, d), ["line", "period"], ["actual", "budget", "variance"]),
    "variance_color_forecast": lambda s, d: finance.variance_colors(
        _fin(s, d).withColumn("forecast", F.when(F.col("category") == "Capital", 1.2e7)
                              .when(F.col("category") == "Expense", 6e6)),
        ["category", "period"]),
    "period_bucket_calendar": lambda s, d: _cal(s, d).select(
        "calendar_date", bi.period_bucket(F.col("calendar_date"), F.lit(CALENDAR_TODAY))
        .alias("period")),
    "month_label_calendar": lambda s, d: _cal(s, d).select(
        "calendar_date", "month_year_text", bi.current_month_label(
            F.col("month_year_text"),
            F.when(F.dayofmonth("calendar_date") != 13, F.dayofmonth("calendar_date") / 31.0),
            F.lit(CALENDAR_TODAY)).alias("current_month_label")),
    "variance_color": lambda s, d: finance.variance_colors(_fin(s, d), ["line", "category",
                                                                         "period"]),
    "variance_color_levels": lambda s, d: finance.variance_color_levels(_fin(s, d), LEVELS[0],
                                                                        LEVELS),
    "days_to_today": lambda s, d: _cal(s, d).select(     # no as-of day given: the current date
        "calendar_date", F.datediff(dataclasses.replace(P, as_of=None).today(), "calendar_date")
        .alias("days"), F.datediff(dataclasses.replace(P, as_of=None, actuals_date=None).cutoff(),
                                   "calendar_date").alias("days_to_cutoff")),
    "variance_color_by_category": lambda s, d: finance.variance_colors(_fin(s, d),
                                                                       ["category", "period"]),
    "field_time_pct": lambda s, d: labour.field_time_pct(_lab(s, d), ["job_level",
                                                                      "calendar_day"]),
    "role_target": lambda s, d: (_lab(s, d).select("job_level").distinct()
                                 .select("job_level", bi.role_target(F.col("job_level"))
                                         .alias("target"))),
    "period_bucket": lambda s, d: labour.with_period_bucket(_lab(s, d), F.lit(LABOUR_TODAY)),
    "utilisation_rag": lambda s, d: labour.labour_kpi(_lab(s, d), F.lit(LABOUR_TODAY)).select(
        "job_level", "month_start", "field_time_pct", "target", "rag"),
    "current_month_label": lambda s, d: labour.labour_kpi(_lab(s, d), F.lit(LABOUR_TODAY)).select(
        "job_level", "month_year_text", "current_month_label"),
    "labour_kpi": lambda s, d: labour.labour_kpi(_lab(s, d), F.lit(LABOUR_TODAY)),
    # phase blocks (R1-R9, final rules) and whole reports
    **{f"phase_{key}": (lambda ph: lambda s, d: phase_rows(inputs(s, d), P, R, ph, "v4"))(ph)
       for key, ph in (("annual_target", "Annual Target"), ("initiation", "Initiation"),
                       ("design", "Design"), ("dependencies", "Dependencies"),
                       ("schedule", "Schedule"), ("execute", "Execute"),
                       ("total_workplan", "Total in WP"), ("eoy_forecast", "EOY Forecast"),
                       ("rebaseline", "Rebaseline"))},
    "scorecard_v1": lambda s, d: scorecard(inputs(s, d), P, R, "v1"),
    "scorecard_v1_unit_thresholds": lambda s, d: scorecard(inputs(s, d), P_UNIT_THRESHOLDS, R,
                                                           "v1"),
    "scorecard_v1_week40": lambda s, d: scorecard(inputs(s, d), P_WEEK40, R, "v1"),
    "scorecard_v2": lambda s, d: scorecard(inputs(s, d), P, R, "v2"),
    "scorecard_v3": lambda s, d: scorecard(inputs(s, d), P, R, "v3"),
    "scorecard_v4": lambda s, d: scorecard(inputs(s, d), P, R, "v4"),
    "scorecard_v4_union_form": lambda s, d: scorecard_union_form(inputs(s, d), P, R, "v4"),
    "scorecard_v4_week40": lambda s, d: scorecard(inputs(s, d), P_WEEK40, R, "v4"),
    "scorecard_v5": lambda s, d: scorecard(inputs(s, d), P_V5, R, "v5"),
    "scorecard_v6": lambda s, d: gated_scorecard(inputs(s, d), _cal(s, d), P_V6_ON, R),
    "scorecard_v6_week_gate": lambda s, d: gated_scorecard(inputs(s, d), _cal(s, d), P_WEEK_GATE,
                                                           R, business_day=1, per="week"),
    # the report as a SQL routine
    **{f"routine_scorecard_{v}": _routine(f"SET VAR (report_version) = (VALUES ('{v}'))",
                                          "SELECT * FROM scorecard") for v in ("v1", "v3", "v4")},
    "routine_scorecard_v4_week40": _routine("SET VAR (report_week) = (VALUES (40))",
                                            "SELECT * FROM scorecard"),
    "routine_gated_open": _routine(
        f"SET VAR (report_as_of, report_cutoff) = (VALUES (DATE'{GATE_ON}', NULL))",
        "SELECT * FROM scorecard_gated"),
    "routine_gated_closed": _routine(
        f"SET VAR (report_as_of, report_cutoff) = (VALUES (DATE'{GATE_OFF}', NULL))",
        "SELECT * FROM scorecard_gated"),
    # sink (S9)
    "sink_number_text": lambda s, d: tables(s, d).lineitem.select(
        "l_orderkey", "l_linenumber",
        report_number_text(F.col("l_extendedprice") / 132).alias("number_text")),
    "sink_tsv_roundtrip": lambda s, d: tsv_roundtrip(scorecard(inputs(s, d), P, R, "v1")),
}
