"""The report as a routine for plain SQL: parameters are session variables, the report a view.

    register_report_routine(spark, inputs, rules, calendar)     # once per session

    SET VAR report_week = 40;
    SET VAR report_cutoff = DATE'2024-10-05';
    SET VAR report_version = 'v1';
    SELECT * FROM scorecard;

    SET VAR report_as_of = current_date();
    SELECT * FROM scorecard_gated;          -- no rows unless it is the n-th business day

The variables play the procedure's parameters, defaults included. Views are stored as text and
analysed anew by each query, so a query sees the values of its moment; the values are constants to
the optimizer, and year tests on dates are ranges, so both reach the scans. (A table function with
parameters would be the nearer form, but Spark refuses aggregates over its parameters and columns.)

The text keeps the shape of :mod:`planscore.plans.scorecard`: one aggregation by program for each of
work items, targets and forecasts, two joins, one generator.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from planscore.params import ProgramRules, ReportParams
from planscore.plans.scorecard import INFORMATIONAL, MEASURED, ScorecardInputs, collated_inputs

CUTOFF = "coalesce(report_cutoff, report_as_of, current_date())"


def _text(value: str | None) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _in(column: str, values) -> str:
    return f"{column} IN ({', '.join(map(_text, values))})" if values else "false"


def _day(value: dt.date | None) -> str:
    return "NULL" if value is None else f"DATE'{value.isoformat()}'"


def _in_year(column: str) -> str:
    return (f"({column} >= make_date(report_year, 1, 1) "
            f"AND {column} < make_date(report_year + 1, 1, 1))")


def variables_sql(params: ReportParams, version: str) -> list[str]:
    """Declarations of the report's parameters with their defaults."""
    return [f"DECLARE OR REPLACE VARIABLE {name} {kind} DEFAULT {value}" for name, kind, value in (
        ("report_week", "INT", params.week), ("report_cutoff", "DATE", _day(params.actuals_date)),
        ("report_as_of", "DATE", _day(params.as_of)), ("report_year", "INT", params.year),
        ("report_rag_min", "DOUBLE", f"{float(params.rag_min)!r}D"),
        ("report_rag_max", "DOUBLE", f"{float(params.rag_max)!r}D"),
        ("report_output", "STRING", _text(params.output)),
        ("report_version", "STRING", _text(version)), ("report_business_day", "INT", 5))]


def actuals_sql(r: ProgramRules, source: str) -> str:
    """A1 and A2: gated sums by program at the cutoff."""
    def by_cutoff(measure: str, out: str, value: str, name: str) -> str:
        return f"sum(CASE WHEN {out} <= {CUTOFF} THEN {value} END) AS {name}"

    def own_year(measure: str) -> str:
        return f"CASE WHEN reporting_year = report_year THEN {measure} ELSE 0D END"
    finished = f"({_in_year('reference_date')} AND status = {_text(r.complete_status)})"
    reported = _in_year("report_date")
    by_reference, execute = _in("program", r.reference_cohort), _in("program", r.execute_cohort)
    maintenance = _in("program", r.maintenance)
    return f"""
SELECT program,
  if({maintenance}, {_text(r.maintenance_label)}, {_text(r.projects_label)}) AS mega_process,
  if({maintenance}, {_text(r.maintenance_owner)}, {_text(r.projects_owner)}) AS owner,
  CAST(NULL AS STRING) AS process,
  {by_cutoff("initiation", "initiation_out", own_year("initiation_actuals"), "initiation_actuals")},
  {by_cutoff("design", "design_out", own_year("design_actuals"), "design_actuals")},
  {by_cutoff("dependency", "dependency_out", own_year("dependency_actuals"), "dependency_actuals")},
  sum(CASE WHEN reporting_year = report_year
            AND (CAST(click_end_date AS DATE) <= date_add({CUTOFF}, 56)
                 OR if({by_reference}, {finished}, {reported}))
           THEN schedule_actuals ELSE 0D END) AS schedule_actuals,
  {by_cutoff("execute", "execute_out",
             f"CASE WHEN if({execute}, {finished}, sub_program <> {_text(r.excluded_sub_program)} "
             f"AND {reported}) THEN execute_actuals ELSE 0D END",
             "execute_actuals_without_external")},
  sum({own_year("in_workplan")}) AS total_in_workplan
FROM {source}
WHERE program <> {_text(r.untracked)}
  AND (program = {_text(r.cancel_exempt)} OR NOT contains(user_status, {_text(r.cancel_marker)}))
  AND (reporting_year = report_year OR {reported} OR ({finished} AND {by_reference}))
GROUP BY program"""


def targets_sql(r: ProgramRules, source: str) -> str:
    """A3, A3b and A4 by program, in one pass over the targets."""
    sums = ", ".join(f"sum(coalesce({t}_ytd_target, 0D)) AS {t}_target"
                     for t in ("initiation", "design", "dependency", "execute"))
    return f"""
SELECT program,
  collect_list(CASE WHEN kind = 'week' THEN struct(initiation_target, design_target,
    dependency_target, execute_target, ytd_completions) END) AS week_rows,
  collect_list(CASE WHEN kind = 'lookahead' THEN schedule_target END) AS schedule_rows,
  count_if(kind = 'lookahead' AND schedule_target IS NULL) AS empty_schedules
FROM (
  SELECT program, kind, month2, month, {sums},
         sum(coalesce(ytd_completions, 0D))
           FILTER (WHERE nickname = {_text(r.external_nickname)}) AS ytd_completions,
         sum(execute_ytd_forecast) AS schedule_target
  FROM (SELECT * EXCEPT (month2, month), if(kind IS NULL, NULL, month2) AS month2,
               if(kind IS NULL, NULL, month) AS month
        FROM (SELECT *, CASE week WHEN report_week THEN 'week'
                                  WHEN report_week + 4 THEN 'lookahead' END AS kind
              FROM {source} WHERE program IS NOT NULL) marked) cut
  GROUP BY program, kind, month2, month) cells
GROUP BY program"""


def rebaselines_sql(r: ProgramRules, source: str) -> str:
    """Distinct rebaselines by program."""
    program = "CASE nickname " + " ".join(
        f"WHEN {_text(a)} THEN {_text(b)}" for a, b in r.nickname_map) + " ELSE nickname END" \
        if r.nickname_map else "nickname"
    return f"""
SELECT program AS r_program, collect_list(struct(program, rebaseline)) AS rebaselines
FROM (SELECT DISTINCT {program} AS program, rebaseline
      FROM (SELECT nickname, sum(coalesce(rebaseline, 0D)) AS rebaseline FROM {source}
            WHERE contains(date_range, CAST(report_year AS STRING)) GROUP BY nickname) sums) pairs
GROUP BY program"""


def phases_sql(r: ProgramRules) -> str:
    """The generator's array: a program's phase rows as (program, phase, plan_raw, actual)."""
    none = "CAST(NULL AS DOUBLE)"

    def row(phase: str, plan: str, actual: str, program: str = "t.program") -> str:
        return (f"named_struct('program', {program}, 'phase', '{phase}', 'plan_raw', {plan}, "
                f"'actual', {actual})")
    planned = [row("Annual Target", "w.initiation_target", none),
               row("Initiation", "w.initiation_target", "initiation_actuals"),
               row("Design", "w.design_target", "design_actuals"),
               row("Dependencies", "w.dependency_target", "dependency_actuals"),
               *[row(p, none, "total_in_workplan") for p in INFORMATIONAL]]
    external = (f"execute_actuals_without_external + if(t.program = {_text(r.external_program)}, "
                "o.ytd_completions, 0D)")
    return f"""concat(
    flatten(transform(week_rows, w -> array({", ".join(planned)}))),
    flatten(transform(week_rows, w -> if(a.program IS NULL,
      array({row("Execute", "w.execute_target", none)}),
      transform(week_rows, o -> {row("Execute", "w.execute_target", external)})))),
    transform(concat(schedule_rows, array_repeat({none}, CAST(empty_schedules AS INT))),
      s -> {row("Schedule", "s", "schedule_actuals")}),
    transform(coalesce(rebaselines, array()),
      b -> {row("Rebaseline", none, "b.rebaseline", "b.program")}))"""


def scorecard_sql(r: ProgramRules, names: dict[str, str]) -> str:
    """The whole report, the version's rules chosen by ``report_version``."""
    measured = f"phase IN ({', '.join(map(_text, MEASURED))})"
    frac = f"program = {_text(r.fractional_program)}"
    black = (f"((phase = 'Design' AND {_in('program', r.design_black)}) "
             f"OR (phase = 'Dependencies' AND {_in('program', r.dependency_black)}))")
    return f"""
WITH program_rows AS (
  SELECT mega_process, owner, process, inline({phases_sql(r)})
  FROM ({targets_sql(r, names["weekly_targets"])}) t
  LEFT JOIN ({rebaselines_sql(r, names["unit_forecast"])}) b ON t.program = b.r_program
  LEFT JOIN ({actuals_sql(r, names["work_items"])}) a ON t.program = a.program),
known AS (
  SELECT *, {measured} AS measured, {frac} AS fractional, coalesce(plan_raw, 0D) AS target,
         report_version IN ('v4', 'v5', 'v6') AS late, report_version IN ('v1', 'v2') AS early,
         coalesce(actual, 0D) AS done
  FROM program_rows),
rounded AS (
  SELECT *, if(late AND fractional, round(done, 2), done) AS shown_done,
         round(try_divide(done, nullif(target, 0D)), 2) AS ratio
  FROM known)
SELECT report_output AS output, mega_process, owner, process, program, '' AS unit_of_measure, phase,
  CASE WHEN measured OR phase = 'Annual Target'
       THEN if(early OR NOT fractional, round(plan_raw, 0), round(plan_raw, 2)) ELSE 0D END AS plan,
  CASE WHEN measured THEN shown_done WHEN phase = 'Annual Target' THEN 0D
       ELSE if(late AND fractional, round(actual, 2), actual) END AS completions,
  CASE WHEN NOT measured THEN 0D
       WHEN report_version = 'v1' THEN CASE WHEN target > 0 AND done = 0 THEN 0D
         WHEN target = 0 THEN 1D ELSE round(try_divide(actual, target), 4) END
       WHEN target = 0 THEN 0D ELSE round(try_divide(shown_done, plan_raw), 4) END AS pct_to_plan,
  '' AS on_track,
  CASE WHEN NOT measured THEN if(phase = 'Annual Target', '', 'GRAY')
       WHEN report_version <> 'v1' THEN '' WHEN {black} THEN 'BLACK'
       WHEN ratio > report_rag_max OR ratio < report_rag_min THEN 'RED' ELSE 'GREEN' END AS rag
FROM rounded"""


def gate_sql(calendar: str) -> str:
    """A row if ``report_as_of`` (default today) is the n-th business day of its month."""
    today = "coalesce(report_as_of, current_date())"
    return f"""
SELECT calendar_date FROM (
  SELECT calendar_date, row_number() OVER (PARTITION BY calendar_year, calendar_month
                                           ORDER BY calendar_date) AS business_day_number
  FROM {calendar}
  WHERE is_business_day AND calendar_date BETWEEN trunc({today}, 'MM') AND last_day({today})) days
WHERE business_day_number = report_business_day AND calendar_date = {today}"""


def register_report_routine(spark: SparkSession, inputs: ScorecardInputs, rules: ProgramRules,
                            calendar: DataFrame | None = None, params: ReportParams | None = None,
                            version: str = "v4", prefix: str = "") -> list[str]:
    """Declare the report's variables (``params`` gives the defaults) and create the views
    ``scorecard`` and, with a calendar, ``scorecard_gated`` (names optionally prefixed) over the
    inputs; return the views' names. The gated report's cutoff is the session's like any other:
    leave ``report_cutoff`` NULL to cut at ``report_as_of``."""
    if rules.collation:
        inputs = collated_inputs(inputs, rules.collation)
    sources = {"work_items": inputs.work_items, "weekly_targets": inputs.weekly_targets,
               "unit_forecast": inputs.unit_forecast, "calendar": calendar}
    names = {}
    for name, df in sources.items():
        if df is not None:
            names[name] = f"{prefix}report_{name}"
            df.createOrReplaceTempView(names[name])
    for statement in variables_sql(params or ReportParams(), version):
        spark.sql(statement)
    made = [f"{prefix}scorecard"]
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {made[0]} AS {scorecard_sql(rules, names)}")
    if calendar is not None:
        made.append(f"{prefix}scorecard_gated")
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {made[1]} AS SELECT * FROM {made[0]} "
                  f"WHERE EXISTS ({gate_sql(names['calendar'])})")
    return made
