"""Work-item actuals: notification grain (A1), program grain (A2) and external completions.

The report sums twice: first to the notification grain with year gates, then to programs with
the cutoff test on each phase-out date. The cutoff test only reads grouping keys of the first
sum, so both sums collapse into one ``groupBy("program")`` over the rows
(:func:`program_actuals`): every task pre-aggregates to at most one row per program before the
shuffle, so a program holding a third of all rows costs nothing extra. The two-level form is
kept (:func:`program_actuals_two_level`) for equivalence tests and for users who need the
notification grain itself (:func:`notification_actuals`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planscore.operators.filters import in_year, reference_complete, report_scope
from planscore.params import ProgramRules, ReportParams

def ZERO() -> Column:
    return F.lit(0.0)

# Grouping keys of the notification grain: 13 descriptive columns and 6 dates. ``schedule_out``
# (source) and ``click_end_date`` are both keys; the output column named schedule_out carries
# the CLICK end date.
NOTIFICATION_KEYS = ("program", "notification", "work_order", "mat", "region", "division",
                     "funding_action", "reporting_year", "work_plan_date", "report_date",
                     "reference_date", "status", "user_status", "initiation_out", "design_out",
                     "dependency_out", "schedule_out", "click_end_date", "execute_out")


def year_gated(measure: str, params: ReportParams) -> Column:
    """The measure counts only in its reporting year, else 0."""
    return F.when(F.col("reporting_year") == params.year, F.col(measure)).otherwise(ZERO())


def schedule_gated(params: ReportParams, rules: ProgramRules) -> Column:
    """Scheduled within eight weeks of the cutoff, or done in the year; the reference-date
    cohort counts completion by reference date instead of report date."""
    # by date: a time of day on the last day of the window still counts
    soon = F.col("click_end_date").cast("date") <= F.date_add(params.cutoff(), 56)
    cohort = F.col("program").isin(*rules.reference_cohort)
    this_year = F.col("reporting_year") == params.year
    return (F.when((soon | in_year("report_date", params.year)) & ~cohort & this_year,
                   F.col("schedule_actuals"))
            .when((soon | reference_complete(params, rules)) & cohort & this_year,
                  F.col("schedule_actuals"))
            .otherwise(ZERO()))


def execute_gated(params: ReportParams, rules: ProgramRules) -> Column:
    """No reporting-year gate. Outside the execute cohort: reported in the year and not the
    excluded sub-program (a NULL sub-program gives 0). Inside: completed by reference date."""
    cohort = F.col("program").isin(*rules.execute_cohort)
    return (F.when(~cohort & (F.col("sub_program") != rules.excluded_sub_program)
                   & in_year("report_date", params.year), F.col("execute_actuals"))
            .when(cohort & reference_complete(params, rules), F.col("execute_actuals"))
            .otherwise(ZERO()))


def notification_actuals(wi: DataFrame, params: ReportParams, rules: ProgramRules,
                         split_hot_keys: bool = True) -> DataFrame:
    """A1: filtered work items summed to the 19-key notification grain.

    Two stages: every task sums what it has, then the partial sums are dealt by a hash of all 19
    keys. The notification alone would be enough to deal them, and work items often arrive
    partitioned by it (the join that adds the order's columns); Spark would then sum in place, and a
    notification that holds a large share of the rows would stay in one task, join included.
    Grouping by the notification as a struct hides that partitioning: an exchange of partial sums
    follows, work orders of one notification go to different tasks, and AQE may split the
    notification's partition in the join below (it does not where that would add an exchange).
    ``split_hot_keys=False`` saves the exchange where no notification is large."""
    keyed = wi.filter(report_scope(params, rules))
    keys: list = list(NOTIFICATION_KEYS)
    if split_hot_keys:
        keys = [F.struct("notification").alias("notification_key"),
                *[k for k in keys if k != "notification"]]
    out = keyed.groupBy(*keys).agg(
        F.sum(year_gated("initiation_actuals", params)).alias("initiation_actuals"),
        F.sum(year_gated("design_actuals", params)).alias("design_actuals"),
        F.sum(year_gated("dependency_actuals", params)).alias("dependency_actuals"),
        F.sum(schedule_gated(params, rules)).alias("schedule_actuals"),
        F.sum(execute_gated(params, rules)).alias("execute_actuals"),
        F.sum(year_gated("in_workplan", params)).alias("in_workplan"),
    )
    if split_hot_keys:
        out = out.withColumn("notification", F.col("notification_key.notification"))
    return out.select(
        *[c for c in NOTIFICATION_KEYS if c not in ("schedule_out", "click_end_date")],
        F.col("click_end_date").alias("schedule_out"),
        "initiation_actuals", "design_actuals", "dependency_actuals", "schedule_actuals",
        "execute_actuals", "in_workplan")


def classify(rules: ProgramRules) -> list[Column]:
    """mega process and owner from the maintenance list; process is always NULL."""
    maint = F.col("program").isin(*rules.maintenance)
    return [
        F.when(maint, F.lit(rules.maintenance_label))
         .otherwise(F.lit(rules.projects_label)).alias("mega_process"),
        F.when(maint, F.lit(rules.maintenance_owner))
         .otherwise(F.lit(rules.projects_owner)).cast("string").alias("owner"),
        F.lit(None).cast("string").alias("process"),
    ]


def _by_cutoff(out_col: str, value: Column, params: ReportParams) -> Column:
    # No ELSE: NULL when nothing qualifies (kept distinct from 0 until the report coalesces).
    # Phase-out columns are dates (FIXTURES.md §1); only the CLICK end may carry a time of day.
    return F.when(F.col(out_col) <= params.cutoff(), value)


ACTUAL_COLUMNS = ("initiation_actuals", "design_actuals", "dependency_actuals",
                  "schedule_actuals", "execute_actuals_without_external", "total_in_workplan")


def program_actuals(wi: DataFrame, params: ReportParams, rules: ProgramRules) -> DataFrame:
    """A2 in one aggregation: program-level actuals at the cutoff."""
    g = wi.filter(report_scope(params, rules)).groupBy("program").agg(
        F.sum(_by_cutoff("initiation_out", year_gated("initiation_actuals", params), params))
         .alias("initiation_actuals"),
        F.sum(_by_cutoff("design_out", year_gated("design_actuals", params), params))
         .alias("design_actuals"),
        F.sum(_by_cutoff("dependency_out", year_gated("dependency_actuals", params), params))
         .alias("dependency_actuals"),
        F.sum(schedule_gated(params, rules)).alias("schedule_actuals"),
        F.sum(_by_cutoff("execute_out", execute_gated(params, rules), params))
         .alias("execute_actuals_without_external"),
        F.sum(year_gated("in_workplan", params)).alias("total_in_workplan"),
    )
    return g.select("program", *classify(rules), *ACTUAL_COLUMNS)


def program_actuals_two_level(a1: DataFrame, params: ReportParams,
                              rules: ProgramRules) -> DataFrame:
    """A2 as written in the report: over the notification grain of :func:`notification_actuals`
    (whose schedule_out column is the CLICK end date)."""
    g = a1.groupBy("program").agg(
        F.sum(_by_cutoff("initiation_out", F.col("initiation_actuals"), params))
         .alias("initiation_actuals"),
        F.sum(_by_cutoff("design_out", F.col("design_actuals"), params)).alias("design_actuals"),
        F.sum(_by_cutoff("dependency_out", F.col("dependency_actuals"), params))
         .alias("dependency_actuals"),
        F.sum("schedule_actuals").alias("schedule_actuals"),
        F.sum(_by_cutoff("execute_out", F.col("execute_actuals"), params))
         .alias("execute_actuals_without_external"),
        F.sum("in_workplan").alias("total_in_workplan"),
    )
    return g.select("program", *classify(rules), *ACTUAL_COLUMNS)


def external_execute(rules: ProgramRules, completions: Column | None = None) -> Column:
    """J2's value: the external program adds the externally tracked completions of its target row
    (``x + NULL`` is NULL when the row carries none)."""
    completions = F.col("ytd_completions") if completions is None else completions
    return (F.when(F.col("program") == rules.external_program,
                   F.col("execute_actuals_without_external") + completions)
            .otherwise(F.col("execute_actuals_without_external")))


def execute_with_external(acts: DataFrame, dot: DataFrame, rules: ProgramRules) -> DataFrame:
    """Program actuals LEFT JOIN the week's target rows; one output row per target row."""
    j = acts.join(dot.select("program", "ytd_completions"), "program", "left")
    return j.select(*acts.columns, external_execute(rules).alias("execute_actuals"))
