"""Oracle SQL per registered query (DuckDB dialect, fixture views as CTEs)."""

from __future__ import annotations

import dataclasses
import datetime as dt

from oracle import (MEASURES, P, R, TOTAL_NAMES, classify_sql, dlit, external_cte, gated_cte,
                    done_rule, exempt_rule, lookahead_cte, nickname_rebaseline_cte, nickname_sql,
                    notification_cte, nth_business_day_sql, plan_rule, q, qlist, rating_rule,
                    ratio_rule, rebaseline_cte, report_ctes, scope_where, scorecard_sql,
                    targets_cte, total, totals_cte, with_ctes)

P_WEEK40 = dataclasses.replace(P, week=40)
P_UNIT = dataclasses.replace(P, rag_min=1.0, rag_max=1.0)
GATE_ON = dt.date(1998, 9, 7)
GATE_OFF = dt.date(1998, 9, 8)
LABOUR_TODAY = dt.date(2024, 1, 15)
CALENDAR_TODAY = dt.date(1995, 6, 15)
P_V5 = dataclasses.replace(P, actuals_date=dt.date(1998, 8, 24))


def _sc(version, p=P, gate_day=None, phase=None, gate_sql=None):
    if gate_day is not None:
        p = dataclasses.replace(p, actuals_date=gate_day)
    gate = gate_sql or (nth_business_day_sql(5, dlit(gate_day)) if gate_day else None)
    return scorecard_sql(version, p, R, gate=gate, phase=phase)


WEEK_GATE_ON = dt.date(1998, 9, 14)
WEEK_GATE_SQL = f"""SELECT calendar_date FROM (
      SELECT calendar_date, row_number() OVER (PARTITION BY calendar_week ORDER BY calendar_date) AS rn
      FROM calendar WHERE is_business_day AND year(calendar_date) = year({dlit(WEEK_GATE_ON)})
                          AND calendar_week = weekofyear({dlit(WEEK_GATE_ON)})) c
    WHERE rn = 1 AND calendar_date = {dlit(WEEK_GATE_ON)}"""


def _phase_sql(phase):
    return _sc("v4", phase=phase)


def _measure(expr: str, name: str) -> str:
    body = (f"SELECT program, phase, plan_raw, actual, {expr} AS {name} FROM phase_rows "
            "WHERE kind = 'measure'")
    return with_ctes(body, *report_ctes())


def _labour_kpi_sql(cols: str) -> str:
    today = dlit(LABOUR_TODAY)
    pct = "(field_work_time / nullif(total_hours - non_productive_time - total_ot_hours, 0))"
    return with_ctes(f"""
SELECT {cols} FROM (
  SELECT job_level, month_start, strftime(month_start, '%m-%Y') AS month_year_text,
         {pct} AS field_time_pct, target,
         CASE WHEN {pct} < target THEN 'RED' ELSE 'GREEN' END AS rag,
         CASE WHEN (year(month_start) * 12 + month(month_start)) - (year({today}) * 12 + month({today})) = 0 THEN 'This Month'
              WHEN (year(month_start) * 12 + month(month_start)) - (year({today}) * 12 + month({today})) < 0 THEN 'Actuals'
              ELSE 'Future' END AS period,
         CASE WHEN strftime(month_start, '%m-%Y') = strftime({today}, '%m-%Y')
              THEN coalesce(printf('%.2f%%', {pct} * 100), '') END AS current_month_label
  FROM (SELECT job_level, CAST(date_trunc('month', calendar_day) AS DATE) AS month_start,
               sum(field_work_time) AS field_work_time, sum(total_hours) AS total_hours,
               sum(non_productive_time) AS non_productive_time, sum(total_ot_hours) AS total_ot_hours,
               min({ROLE_TARGET_SQL}) AS target
        FROM labour_by_day GROUP BY 1, 2) g) k""")


ROLE_TARGET_SQL = ("CASE WHEN job_level = 'Supervisor' THEN 0.5E0 WHEN job_level = 'Manager' THEN 0.25E0 "
                   "WHEN job_level = 'Senior Leader' THEN 0.15E0 END")


VARIANCE_COLOR = """CASE WHEN period IN ('EOY', 'YTD') AND coalesce(variance, 0E0) >= lim
                   AND (CASE WHEN actual IS NULL THEN false
                             WHEN coalesce(budget, 0E0) <> 0 THEN abs(actual / coalesce(budget, 0E0)) >= 0.02
                             ELSE actual <> 0 END) THEN '#FF0000'
              WHEN period IN ('EOY', 'YTD') AND coalesce(variance, 0E0) < lim
                   AND (CASE WHEN actual IS NULL THEN true
                             WHEN coalesce(budget, 0E0) <> 0 THEN abs(actual / coalesce(budget, 0E0)) < 0.02
                             ELSE false END) THEN '#00FF00'
              ELSE '#FFA500' END"""
VARIANCE_LIMIT = ("CASE WHEN category = 'Capital' THEN 10000000E0 WHEN category IN ('Expense', "
                  "'Non-Core/ Other Bal Sheet', 'Non-EIE') THEN 5000000E0 END")


def _variance_sql(keys: list[str], forecast: str | None = None) -> str:
    """``forecast``: an expression over the keys that stands in for an actual that is not one
    value."""
    cols = [c for c in ("category", "period", "actual", "budget", "variance") if c not in keys]
    k = ", ".join(keys)
    sel = ", ".join(
        f"CASE WHEN (count({c}) = count(*) AND min({c}) = max({c})) OR count({c}) = 0 THEN max({c}) END AS {c}"
        for c in cols)
    if forecast:
        sel = sel.replace("THEN max(actual) END AS actual",
                          f"THEN max(actual) ELSE {forecast} END AS actual")
    color, lim = VARIANCE_COLOR, VARIANCE_LIMIT
    return with_ctes(f"""
SELECT {k}, {', '.join(cols)}, {color} AS color FROM (
  SELECT *, {lim} AS lim FROM (SELECT {k}, {sel} FROM finance_rows GROUP BY {k}) s) v""")


WI = "SELECT * FROM work_items"


def _with_texts(report: str) -> str:
    """The report with its numbers as printed: 15 significant digits, plain decimals."""
    texts = ", ".join(f"printf('%.15g', {c}) AS {c}_text"
                      for c in ("plan", "completions", "pct_to_plan"))
    return f"SELECT *, {texts} FROM ({report}) printed"


def _totals(*measures: str) -> str:
    return with_ctes("SELECT program, " + ", ".join(f"{total(m)} AS {m}" for m in measures)
                     + " FROM facts GROUP BY program", gated_cte())


def _gate_counts_sql() -> str:
    days = ", ".join(
        f"CAST(sum(CASE WHEN EXISTS ({nth_business_day_sql(5, dlit(day))}) THEN 1 ELSE 0 END) "
        f"AS BIGINT) AS {name}" for name, day in (("n_open", GATE_ON), ("n_closed", GATE_OFF)))
    return with_ctes(f"SELECT month, count(*) AS n_rows, {days} FROM weekly_targets GROUP BY month")


def _bucket_sql(day: str, today) -> str:
    return (f"CASE sign(datediff('month', {dlit(today)}, {day})) WHEN 0 THEN 'This Month' "
            f"WHEN -1 THEN 'Actuals' ELSE 'Future' END")


def _by_week_sql() -> str:
    """Totals at each Sunday of the year, every cutoff on its own."""
    last = "c.cutoff + INTERVAL 56 DAY"
    sums = []
    for name, (value, out, gate) in MEASURES.items():
        if gate == "gate_schedule":
            gate = (f"coalesce(this_year AND (CAST(click_end_date AS DATE) <= {last} "
                    "OR if(by_reference, finished, reported)), false)")
        kept = f" FILTER (WHERE {out} <= c.cutoff)" if out else ""
        sums.append(f"sum(if({gate}, {value}, 0E0)){kept} AS {TOTAL_NAMES.get(name, name)}")
    return with_ctes(f"""
SELECT c.cutoff, program, {classify_sql()}, {', '.join(sums)}
FROM facts, (SELECT CAST(unnest(generate_series(DATE '1998-01-04', DATE '1998-12-27',
                                                INTERVAL 7 DAY)) AS DATE) AS cutoff) c
GROUP BY c.cutoff, program""", gated_cte())


def _variance_levels_sql() -> str:
    """Selected values of all rows of each level, keys included."""
    names = ("line", "category", "period", "actual", "budget", "variance")
    sel = ", ".join(f"if(count(DISTINCT coalesce(CAST(v_{c} AS VARCHAR), 'blank')) = 1, "
                    f"any_value(v_{c}), NULL) AS {c}" for c in names)
    copies = ", ".join(f"{c} AS v_{c}" for c in names)
    return with_ctes(f"""
SELECT level, line, category, period, actual, budget, variance, {VARIANCE_COLOR} AS color
FROM (SELECT *, {VARIANCE_LIMIT} AS lim
      FROM (SELECT CAST(grouping(line, category, period) AS BIGINT) AS level, {sel}
            FROM (SELECT line, category, period, {copies} FROM finance_rows) f
            GROUP BY GROUPING SETS ((line, category, period), (category, period), (period), ())) g) x""")


ORACLE: dict[str, str] = {
    "program_actuals_by_week": _by_week_sql(),
    "variance_color_levels": _variance_levels_sql(),
    "days_to_today": with_ctes(
        "SELECT calendar_date, CAST(date_diff('day', calendar_date, current_date) AS INT) AS days, "
        "CAST(date_diff('day', calendar_date, current_date) AS INT) AS days_to_cutoff FROM calendar"),
    "source_work_items": with_ctes(WI),
    "source_weekly_targets": with_ctes("SELECT * FROM weekly_targets"),
    "source_unit_forecast": with_ctes("SELECT * FROM unit_forecast"),
    "source_finance_rows": with_ctes("SELECT * FROM finance_rows"),
    "source_labour_by_day": with_ctes("SELECT * FROM labour_by_day"),
    "dim_calendar": with_ctes("SELECT * FROM calendar"),
    "week_lookup_distinct": with_ctes(
        f"""SELECT DISTINCT week, month, month2, date_range FROM weekly_targets JOIN (
        SELECT week, month, min(d) || ' - ' || max(d) AS date_range
        FROM (SELECT CAST(unnest(generate_series(DATE '{P.year}-01-01', DATE '{P.year}-12-31',
                                                 INTERVAL 1 DAY)) AS DATE) AS d,
                     CAST(weekofyear(d) AS INT) AS week, CAST(month(d) AS INT) AS month) days
        GROUP BY week, month) s USING (week, month) WHERE week = {P.week}"""),
    "filter_tracked": with_ctes(f"{WI} WHERE program IS NOT NULL AND program <> {q(R.untracked)}"),
    "filter_cancelled_exempt": with_ctes(
        f"{WI} WHERE (user_status NOT LIKE '%CNCL%' AND program <> {q(R.cancel_exempt)}) "
        f"OR program = {q(R.cancel_exempt)}"),
    "filter_year_eligible": with_ctes(
        f"{WI} WHERE reporting_year = {P.year} OR year(report_date) = {P.year} "
        f"OR (year(reference_date) = {P.year} AND status = 'COMP' "
        f"AND program IN ({qlist(R.reference_cohort)}))"),
    "cohort_semi": with_ctes(f"{WI} WHERE program IN ({qlist(R.reference_cohort)})"),
    "cohort_anti": with_ctes(
        f"{WI} WHERE program NOT IN ({qlist(R.reference_cohort)})"),
    "filter_label_year": with_ctes(f"SELECT * FROM unit_forecast WHERE date_range LIKE '%{P.year}%'"),
    "filter_week": with_ctes(f"SELECT * FROM weekly_targets WHERE week = {P.week} AND program IS NOT NULL"),
    "filter_week_lookahead": with_ctes(
        f"SELECT * FROM weekly_targets WHERE week = {P.week + 4} AND program IS NOT NULL"),
    "classify_program": with_ctes(
        f"SELECT program, {classify_sql(R)} FROM (SELECT DISTINCT program FROM work_items "
        f"WHERE program IS NOT NULL AND program <> {q(R.untracked)}) d"),
    "normalize_nickname": with_ctes(
        f"SELECT nickname, {nickname_sql('nickname', R)} AS program "
        f"FROM (SELECT DISTINCT nickname FROM unit_forecast) d"),
    "notification_actuals": with_ctes("SELECT * FROM a1", gated_cte(), notification_cte()),
    "agg_year_gated": _totals("initiation_actuals", "design_actuals", "dependency_actuals",
                              "in_workplan"),
    "agg_schedule_8w": _totals("schedule_actuals"),
    "agg_execute_completed": _totals("execute_actuals"),
    **{k: with_ctes("SELECT * FROM acts", gated_cte(), totals_cte())
       for k in ("program_actuals", "program_actuals_streamed", "program_actuals_two_level")},
    **{k: with_ctes("SELECT * FROM reb", nickname_rebaseline_cte(), rebaseline_cte())
       for k in ("rebaseline_semi", "rebaseline_inner_distinct")},
    "business_days_in_month": with_ctes(
        f"SELECT * FROM calendar WHERE is_business_day AND year(calendar_date) = {GATE_ON.year} "
        f"AND month(calendar_date) = {GATE_ON.month}"),
    "weekly_targets": with_ctes("SELECT * FROM dot", targets_cte()),
    "nickname_completions": with_ctes(
        "SELECT program, week, month2, month, ytd_completions FROM dot", targets_cte()),
    "schedule_target": with_ctes("SELECT * FROM sched", lookahead_cte()),
    "rebaseline_by_nickname": with_ctes("SELECT * FROM reb_nick", nickname_rebaseline_cte()),
    "join_left_plan_actual": with_ctes(
        "SELECT * FROM dot LEFT JOIN acts USING (program)",
        gated_cte(), totals_cte(), targets_cte()),
    "execute_with_external": with_ctes("SELECT * FROM wdot", gated_cte(), totals_cte(),
                                       targets_cte(), external_cte()),
    "plan_rounding": _measure(plan_rule("v3"), "plan"),
    "completions_rounding": _measure(done_rule("v4", "coalesce(actual, 0E0)"), "completions"),
    **{f"pct_to_plan_{v}": _measure(ratio_rule(v), "pct_to_plan") for v in ("v1", "v2", "v4")},
    "rag_threshold": _measure(rating_rule(), "rag"),
    "rag_black_override": _measure(f"if({exempt_rule()}, 'BLACK', {rating_rule()})", "rag"),
    "nth_business_day_month": with_ctes(
        "SELECT calendar_date, calendar_year, calendar_month, CAST(rn AS INT) AS business_day_number FROM ("
        "SELECT *, row_number() OVER (PARTITION BY calendar_year, calendar_month ORDER BY calendar_date) AS rn "
        "FROM calendar WHERE is_business_day) c WHERE rn = 5"),
    "first_business_day_week": with_ctes(
        "SELECT calendar_date, calendar_week, CAST(rn AS INT) AS business_day_number FROM ("
        "SELECT *, row_number() OVER (PARTITION BY calendar_week ORDER BY calendar_date) AS rn "
        f"FROM calendar WHERE is_business_day AND calendar_year = {P.year}) c WHERE rn = 1"),
    "gate_exists_counts": _gate_counts_sql(),
    "selected_value_cells": with_ctes(
        "SELECT line, period, " + ", ".join(
            f"if(count(DISTINCT coalesce(CAST({c} AS VARCHAR), 'blank')) = 1, any_value({c}), NULL) "
            f"AS {c}" for c in ("actual", "budget", "variance"))
        + " FROM finance_rows GROUP BY line, period"),
    "period_bucket_calendar": with_ctes(
        f"SELECT calendar_date, {_bucket_sql('calendar_date', CALENDAR_TODAY)} AS period "
        "FROM calendar"),
    "month_label_calendar": with_ctes(
        "SELECT calendar_date, month_year_text, CASE WHEN calendar_year = 1995 AND "
        "calendar_month = 6 THEN CASE WHEN day(calendar_date) = 13 THEN '' ELSE "
        "printf('%.2f%%', day(calendar_date) / 31.0 * 100) END END AS current_month_label "
        "FROM calendar"),
    "variance_color_forecast": _variance_sql(
        ["category", "period"], "CASE category WHEN 'Capital' THEN 1.2e7 WHEN 'Expense' THEN 6e6 "
        "END"),
    "gated_report": _sc("v4", gate_day=GATE_OFF),
    "selected_value": with_ctes(
        "SELECT category, period, " + ", ".join(
            f"CASE WHEN (count({c}) = count(*) AND min({c}) = max({c})) OR count({c}) = 0 "
            f"THEN max({c}) END AS {c}" for c in ("actual", "budget", "variance"))
        + " FROM finance_rows GROUP BY category, period"),
    "variance_color": _variance_sql(["line", "category", "period"]),
    "variance_color_by_category": _variance_sql(["category", "period"]),
    "field_time_pct": with_ctes(
        "SELECT job_level, calendar_day, sum(field_work_time) / nullif(sum(total_hours) - "
        "sum(non_productive_time) - sum(total_ot_hours), 0) AS field_time_pct "
        "FROM labour_by_day GROUP BY job_level, calendar_day"),
    "role_target": with_ctes(
        f"SELECT job_level, {ROLE_TARGET_SQL} AS target FROM (SELECT DISTINCT job_level FROM labour_by_day) d"),
    "period_bucket": with_ctes(
        "SELECT calendar_day, user_id, job_level, field_work_time, total_hours, non_productive_time, "
        "total_ot_hours, CASE WHEN d = 0 THEN 'This Month' WHEN d < 0 THEN 'Actuals' ELSE 'Future' END AS period "
        "FROM (SELECT *, (year(calendar_day) * 12 + month(calendar_day)) - "
        f"(year({dlit(LABOUR_TODAY)}) * 12 + month({dlit(LABOUR_TODAY)})) AS d FROM labour_by_day) x"),
    "utilisation_rag": _labour_kpi_sql("job_level, month_start, field_time_pct, target, rag"),
    "current_month_label": _labour_kpi_sql("job_level, month_year_text, current_month_label"),
    "labour_kpi": _labour_kpi_sql("*"),
    **{f"phase_{key}": _phase_sql(ph)
       for key, ph in (("annual_target", "Annual Target"), ("initiation", "Initiation"),
                       ("design", "Design"), ("dependencies", "Dependencies"),
                       ("schedule", "Schedule"), ("execute", "Execute"),
                       ("total_workplan", "Total in WP"), ("eoy_forecast", "EOY Forecast"),
                       ("rebaseline", "Rebaseline"))},
    "scorecard_v1": _sc("v1"),
    "scorecard_v1_unit_thresholds": _sc("v1", P_UNIT),
    "scorecard_v1_week40": _sc("v1", P_WEEK40),
    "scorecard_v2": _sc("v2"),
    "scorecard_v3": _sc("v3"),
    "scorecard_v4": _sc("v4"),
    "scorecard_v4_union_form": _sc("v4"),
    "scorecard_v4_week40": _sc("v4", P_WEEK40),
    "scorecard_v5": _sc("v5", P_V5),
    "scorecard_v6": _sc("v4", gate_day=GATE_ON),
    "scorecard_v6_week_gate": _sc("v4", gate_day=WEEK_GATE_ON, gate_sql=WEEK_GATE_SQL),
    **{f"routine_scorecard_{v}": _sc(v) for v in ("v1", "v3", "v4")},
    "routine_scorecard_v4_week40": _sc("v4", P_WEEK40),
    "routine_gated_open": _sc("v4", gate_day=GATE_ON),
    "routine_gated_closed": _sc("v4", gate_day=GATE_OFF),
    "sink_number_text": "SELECT l_orderkey, l_linenumber, printf('%.15g', l_extendedprice / 132) "
                        "AS number_text FROM lineitem",
    "sink_tsv_roundtrip": _with_texts(_sc("v1")),
}
