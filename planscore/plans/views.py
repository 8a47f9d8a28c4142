"""The report's stages as temporary views, for SQL users and BI tools on Spark SQL.

    register_report_views(spark, inputs, params, rules)
    spark.sql("SELECT program, phase, pct_to_plan FROM scorecard_v4 WHERE rag = 'RED'")

Views are lazy: each query against them is planned and optimised as a whole, so a filter on
``program`` reaches the scans as it would in the DataFrame API.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from planscore.operators.actuals import program_actuals
from planscore.operators.targets import rebaselines, schedule_targets, targets_at_week
from planscore.params import ProgramRules, ReportParams
from planscore.plans.scorecard import (VERSIONS, ScorecardInputs, collated_inputs,
                                       scorecard)


def register_report_views(spark: SparkSession, inputs: ScorecardInputs, params: ReportParams,
                          rules: ProgramRules, prefix: str = "") -> list[str]:
    """Register ``work_items``, ``program_actuals``, ``week_targets``, ``schedule_targets``,
    ``rebaselines`` and ``scorecard_v1`` … ``scorecard_v5`` (names optionally prefixed); return
    the names."""
    if rules.collation:   # the stage views compare names as the scorecards do
        inputs = collated_inputs(inputs, rules.collation)
    views = {
        "weekly_targets": inputs.weekly_targets,
        "unit_forecast": inputs.unit_forecast,
        "week_targets": targets_at_week(inputs.weekly_targets, params, rules),
        "schedule_targets": schedule_targets(inputs.weekly_targets, params),
        "rebaselines": rebaselines(inputs.unit_forecast, inputs.weekly_targets, params, rules),
    }
    if inputs.work_items is not None:
        views["work_items"] = inputs.work_items
    views["program_actuals"] = (inputs.program_actuals if inputs.program_actuals is not None
                                else program_actuals(inputs.work_items, params, rules))
    for v in VERSIONS[:5]:
        views[f"scorecard_{v}"] = scorecard(inputs, params, rules, v)
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + n for n in views]
