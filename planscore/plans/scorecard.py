"""The stacked scorecard (R1-R9) in all report versions.

The report builds nine SELECTs, each a LEFT JOIN of a target table to the program actuals, and
UNION ALLs them. Here everything is brought to one row per program first: the targets in one pass
(the week, the look-ahead week and the mere presence of a program as kinds of one aggregation), the
distinct rebaselines, and the actuals. Three aggregations by program meet in two joins, and one
generator writes a program's phase rows. Work items, targets and forecasts are each read once;
after them there are at most programs x months rows.

Row multiplicities match the report:
* a week spanning two months gives two target rows per program, hence two rows per phase;
* Execute joins targets to (actuals LEFT JOIN targets), so it fans out m x m for a program with
  m target rows and actuals, and m rows for a program without actuals;
* programs with two rebaseline values keep both rows;
* rebaselines count for programs that have targets in any week.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planscore.functions import measures as M
from planscore.functions.collation import with_collation, without_collation
from planscore.operators.actuals import external_execute, program_actuals
from planscore.operators.targets import (program_targets, rebaseline_by_nickname, rebaselines,
                                         schedule_targets, targets_at_week)
from planscore.params import ProgramRules, ReportParams

PHASES = ("Annual Target", "Initiation", "Design", "Dependencies", "Schedule", "Execute",
          "Total in WP", "EOY Forecast", "Rebaseline")
MEASURED = ("Initiation", "Design", "Dependencies", "Schedule", "Execute")
INFORMATIONAL = ("Total in WP", "EOY Forecast")

OUTPUT_COLUMNS = ("output", "mega_process", "owner", "process", "program", "unit_of_measure",
                  "phase", "plan", "completions", "pct_to_plan", "on_track", "rag")

VERSIONS = ("v1", "v2", "v3", "v4", "v5", "v6")


@dataclass(frozen=True)
class ScorecardInputs:
    work_items: DataFrame | None
    weekly_targets: DataFrame
    unit_forecast: DataFrame
    # Precomputed program actuals (e.g. from the streaming rollup); replaces the work-item scan.
    program_actuals: DataFrame | None = None


def program_rows(inputs: ScorecardInputs, params: ReportParams, rules: ProgramRules) -> DataFrame:
    """One row per program of the targets: ``week_rows`` and ``schedule_rows`` (its target rows of
    the week and of the look-ahead week), ``rebaselines`` (distinct values, NULL without any), the
    program actuals and ``has_actuals``."""
    acts = (inputs.program_actuals if inputs.program_actuals is not None
            else program_actuals(inputs.work_items, params, rules))
    reb = (rebaseline_by_nickname(inputs.unit_forecast, params, rules)
           .select("program", "rebaseline").distinct()
           .groupBy(F.col("program").alias("r_program"))
           .agg(F.collect_list(F.struct("program", "rebaseline")).alias("rebaselines")))
    acts = acts.withColumnRenamed("program", "a_program").withColumn("has_actuals", F.lit(True))
    return (program_targets(inputs.weekly_targets, params, rules)
            .join(reb, F.col("program") == F.col("r_program"), "left")
            .join(acts, F.col("program") == F.col("a_program"), "left")
            .drop("r_program", "a_program"))


def _phase_row(phase: str, plan, actual, program=None) -> Column:
    null = F.lit(None).cast("double")
    return F.struct((F.col("program") if program is None else program).alias("program"),
                    F.lit(phase).alias("phase"), (null if plan is None else plan).alias("plan_raw"),
                    (null if actual is None else actual).alias("actual"))


def joined_phase_rows(inputs: ScorecardInputs, params: ReportParams,
                      rules: ProgramRules) -> DataFrame:
    """Plan rows LEFT JOIN actual rows: (program, phase, plan_raw, actual, mega_process, owner,
    process), before any version's measure rules."""
    rows = program_rows(inputs, params, rules)

    def per_target(t: Column) -> Column:
        return F.array(
            _phase_row("Annual Target", t.initiation_target, None),
            _phase_row("Initiation", t.initiation_target, F.col("initiation_actuals")),
            _phase_row("Design", t.design_target, F.col("design_actuals")),
            _phase_row("Dependencies", t.dependency_target, F.col("dependency_actuals")),
            *[_phase_row(ph, None, F.col("total_in_workplan")) for ph in INFORMATIONAL])

    def execute(t: Column) -> Column:
        """The actuals carry one row per target row (J2), so each target row meets all of them."""
        return (F.when(F.col("has_actuals"), F.transform("week_rows", lambda other: _phase_row(
                    "Execute", t.execute_target,
                    external_execute(rules, other.ytd_completions))))
                .otherwise(F.array(_phase_row("Execute", t.execute_target, None))))
    phases = F.concat(
        F.flatten(F.transform("week_rows", per_target)),
        F.flatten(F.transform("week_rows", execute)),
        F.transform("schedule_rows", lambda t: _phase_row(
            "Schedule", t.schedule_target, F.col("schedule_actuals"))),
        F.coalesce(F.transform("rebaselines", lambda r: _phase_row(
            "Rebaseline", None, r.rebaseline, r.program)), F.array()))
    stacked = rows.select("mega_process", "owner", "process", F.inline(phases))
    return stacked.select("program", "phase", "plan_raw", "actual", "mega_process", "owner",
                          "process")


def _measures(version: str, params: ReportParams, rules: ProgramRules) -> list[Column]:
    phase, program = F.col("phase"), F.col("program")
    raw, actual = F.col("plan_raw"), F.col("actual")
    measured = phase.isin(*MEASURED)
    late = version in ("v4", "v5", "v6")
    zero = F.lit(0.0)

    plan_rule = M.plan_v1(raw) if version in ("v1", "v2") else M.plan_v3(raw, program, rules)
    plan = F.when(measured | (phase == "Annual Target"), plan_rule).otherwise(zero)

    if late:
        comp_measured = M.completions_v4(actual, program, rules)
        comp_info = M.round_fractional(actual, program, rules)
    else:
        comp_measured = M.completions_v1(actual)
        comp_info = actual
    completions = (F.when(measured, comp_measured)
                   .when(phase == "Annual Target", zero).otherwise(comp_info))

    if version == "v1":
        pct_rule = M.pct_v1(raw, actual)
    elif late:
        pct_rule = M.pct_v4(raw, actual, program, rules)
    else:
        pct_rule = M.pct_v2(raw, actual)
    pct = F.when(measured, pct_rule).otherwise(zero)

    if version == "v1":
        phase_rag = M.rag_threshold(raw, actual, params, M.black_override(phase, program, rules))
    else:
        phase_rag = F.lit("")
    rag = (F.when(measured, phase_rag).when(phase == "Annual Target", F.lit(""))
           .otherwise(F.lit("GRAY")))
    return [plan.alias("plan"), completions.alias("completions"), pct.alias("pct_to_plan"),
            rag.alias("rag")]


def apply_version(rows: DataFrame, version: str, params: ReportParams,
                  rules: ProgramRules) -> DataFrame:
    """Project joined phase rows to the 12 output columns under one version's rules."""
    if version not in VERSIONS:
        raise ValueError(f"unknown version {version!r}")
    plan, completions, pct, rag = _measures(version, params, rules)
    return rows.select(
        F.lit(params.output).alias("output"), "mega_process", "owner", "process", "program",
        F.lit("").alias("unit_of_measure"), "phase", plan, completions, pct,
        F.lit("").alias("on_track"), rag)


def scorecard(inputs: ScorecardInputs, params: ReportParams, rules: ProgramRules,
              version: str = "v4") -> DataFrame:
    """The stacked scorecard, unsorted (sort only at the sink; see :mod:`planscore.sources.sinks`).

    v1: whole-number plan, percent rule v1, full RAG. v2: percent rule v2, phase RAG blank.
    v3: two-decimal plan for the fractional program. v4: its completions too. v5: v4 with the
    cutoff defaulting to ``as_of``. v6 (gated) is :func:`planscore.plans.gate.gated_scorecard`.
    With ``rules.collation`` set, names compare under that collation."""
    if rules.collation:
        inputs = collated_inputs(inputs, rules.collation)
        rows = joined_phase_rows(inputs, params, rules)
        return without_collation(apply_version(rows, version, params, rules))
    return apply_version(joined_phase_rows(inputs, params, rules), version, params, rules)


def collated_inputs(inputs: ScorecardInputs, collation: str) -> ScorecardInputs:
    def c(df):
        return None if df is None else with_collation(df, collation)
    return ScorecardInputs(c(inputs.work_items), c(inputs.weekly_targets),
                           c(inputs.unit_forecast), c(inputs.program_actuals))


def phase_rows(inputs: ScorecardInputs, params: ReportParams, rules: ProgramRules,
               phase: str, version: str = "v4") -> DataFrame:
    """One phase block (R1-R9) of a version."""
    return scorecard(inputs, params, rules, version).filter(F.col("phase") == phase)


def scorecard_union_form(inputs: ScorecardInputs, params: ReportParams, rules: ProgramRules,
                         version: str = "v4") -> DataFrame:
    """The report's own shape: nine LEFT JOINs of a target table to the actuals, UNION ALL.

    Kept for equivalence tests and for the benchmark against :func:`scorecard`; the one-pass form
    is the one to run."""
    acts = (inputs.program_actuals if inputs.program_actuals is not None
            else program_actuals(inputs.work_items, params, rules))
    dot = targets_at_week(inputs.weekly_targets, params, rules)
    wdot = acts.join(dot.select("program", "ytd_completions"), "program", "left").select(
        *acts.columns, external_execute(rules).alias("execute_actuals"))
    sched = schedule_targets(inputs.weekly_targets, params)
    reb = rebaselines(inputs.unit_forecast, inputs.weekly_targets, params, rules)
    null = F.lit(None).cast("double")
    blocks = []
    for phase, src, raw, side, actual in (
            ("Annual Target", dot, "initiation_target", acts, None),
            ("Initiation", dot, "initiation_target", acts, "initiation_actuals"),
            ("Design", dot, "design_target", acts, "design_actuals"),
            ("Dependencies", dot, "dependency_target", acts, "dependency_actuals"),
            ("Schedule", sched, "schedule_target", acts, "schedule_actuals"),
            ("Execute", dot, "execute_target", wdot, "execute_actuals"),
            ("Total in WP", dot, None, acts, "total_in_workplan"),
            ("EOY Forecast", dot, None, acts, "total_in_workplan"),
            ("Rebaseline", reb, None, acts, None)):
        j = src.alias("t").join(side.alias("a"), F.col("t.program") == F.col("a.program"), "left")
        act = (F.col("t.rebaseline") if phase == "Rebaseline"
               else F.col(f"a.{actual}") if actual else null)
        blocks.append(j.select(
            F.col("t.program").alias("program"), F.lit(phase).alias("phase"),
            (F.col(f"t.{raw}") if raw else null).alias("plan_raw"), act.alias("actual"),
            F.col("a.mega_process"), F.col("a.owner"), F.col("a.process")))
    rows = blocks[0]
    for b in blocks[1:]:
        rows = rows.unionByName(b)
    return apply_version(rows, version, params, rules)
