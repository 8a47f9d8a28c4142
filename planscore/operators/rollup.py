"""Program actuals (A2, A1b) at many cutoffs in one pass over the program-day rollup.

Asking the rollup (:mod:`planscore.streaming.actuals_rollup`) for each cutoff in turn reads it once
per cutoff. Here every rollup row goes to the first cutoff that counts it, and a running sum over
the cutoffs of each (program, measure) answers all of them: prefix sums, read once."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planscore.operators.actuals import ACTUAL_COLUMNS, classify
from planscore.params import ProgramRules

MEASURES = {"initiation": "initiation_actuals", "design": "design_actuals",
            "dependency": "dependency_actuals", "schedule": "schedule_actuals",
            "execute": "execute_actuals_without_external", "in_workplan": "total_in_workplan"}
SCHEDULE_DAYS = 56


def first_cutoff(cutoffs: list[dt.date]) -> Column:
    """Position of the first of the (ascending) cutoffs that counts a rollup row, their number if
    none does. Schedule rows count from eight weeks before their date on."""
    due = F.when(F.col("measure") == "schedule", F.date_sub("out_date", SCHEDULE_DAYS)).otherwise(
        F.col("out_date"))
    days = F.array(*[F.lit(c) for c in cutoffs])
    return (F.when(F.col("always"), F.lit(0)).when(due.isNull(), F.lit(len(cutoffs)))
            .otherwise(F.size(F.filter(days, lambda c: c < due))))


def program_actuals_at_cutoffs(rollup: DataFrame, cutoffs: list[dt.date],
                               rules: ProgramRules) -> DataFrame:
    """The columns of :func:`planscore.operators.actuals.program_actuals` for every cutoff, plus
    ``cutoff``; values and NULLs as :func:`program_actuals_from_rollup` gives them one by one.

    A window partition holds one row per cutoff; programs x measures x cutoffs rows in all."""
    cutoffs = sorted(set(cutoffs))
    late = F.when(F.col("always"), F.lit(0)).otherwise(F.col("n_rows"))
    sums = rollup.groupBy("program", "measure", first_cutoff(cutoffs).alias("at")).agg(
        F.sum("value").alias("value"), F.sum("n_values").alias("n_values"),
        F.sum(late).alias("late"))
    grid = (rollup.select("program").distinct()
            .select("program", F.explode(F.array(*[F.lit(m) for m in MEASURES])).alias("measure"))
            .select("*", F.explode(F.sequence(F.lit(0), F.lit(len(cutoffs) - 1))).alias("at")))
    cells = (sums.unionByName(grid, allowMissingColumns=True)
             .groupBy("program", "measure", "at")
             .agg(*[F.sum(c).alias(c) for c in ("value", "n_values", "late")]))
    whole = Window.partitionBy("program", "measure")
    until = whole.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def running(name: str) -> Column:
        return F.sum(name).over(until)
    zero = F.lit(0)
    # a schedule row that does not count yet still contributes 0
    waiting = F.coalesce(F.sum("late").over(whole) - F.coalesce(running("late"), zero), zero)
    seen = F.coalesce(running("n_values"), zero) + waiting
    value = running("value")
    total = (F.when(F.col("measure") != "schedule", value)
             .when(seen > 0, F.coalesce(value, F.lit(0.0))))
    totals = cells.select("program", "measure", "at", total.alias("total")).filter(
        F.col("at") < len(cutoffs))
    days = F.array(*[F.lit(c) for c in cutoffs])
    g = totals.groupBy("program", "at").agg(*[
        F.max(F.when(F.col("measure") == m, F.col("total"))).alias(name)
        for m, name in MEASURES.items()])
    return g.select(F.element_at(days, F.col("at") + 1).alias("cutoff"), "program",
                    *classify(rules), *ACTUAL_COLUMNS)
