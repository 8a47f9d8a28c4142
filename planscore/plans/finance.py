"""Finance variance colour (B1) over selected values per visual cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planscore.functions import bi
from planscore.operators.grouping import (selected_value_states, selected_values,
                                          selected_values_levels)

VALUE_COLUMNS = ("category", "period", "actual", "budget", "variance")


def variance_colors(fin: DataFrame, keys: list[str]) -> DataFrame:
    """One colour per group of ``keys``: each input is the group's single value or blank.

    If the rows carry a ``forecast`` column, the actual falls back to the group's single
    forecast when the actual is not single-valued (``SELECTEDVALUE(Actual, Forecast)``)."""
    cols = [c for c in VALUE_COLUMNS if c not in keys]
    alts = {}
    if "forecast" in fin.columns and "actual" in cols:
        cols = cols + ["forecast"]
        alts["actual"] = F.col("forecast")
    sel = selected_values(fin, keys, cols, alts)
    cols = [c for c in cols if c != "forecast"]
    return sel.select(*keys, *cols,
                      bi.variance_color(F.col("category"), F.col("period"), F.col("actual"),
                                        F.col("budget"), F.col("variance")).alias("color"))


def variance_color_levels(fin: DataFrame, keys: list[str], levels: list[list[str]]) -> DataFrame:
    """Colours of several visual levels (cells, subtotals, the total) in one plan: one state per
    finest group of ``keys``, merged up to each of ``levels``."""
    cols = [c for c in VALUE_COLUMNS if c not in keys]
    sel = selected_values_levels(selected_value_states(fin, keys, cols), keys, cols, levels)
    return sel.withColumn("color", bi.variance_color(
        F.col("category"), F.col("period"), F.col("actual"), F.col("budget"), F.col("variance")))
