"""Field-labour utilisation KPI (B2-B6): percent of productive hours spent in the field, with role
targets, RAG, period buckets and the current-month label.

One ``groupBy`` over the daily labour rows; every measure is a ratio of sums, so the aggregation
is fully algebraic (map-side partial sums, no skew exposure)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planscore.functions import bi


def _sums() -> list[Column]:
    return [F.sum("field_work_time").alias("field_work_time"),
            F.sum("total_hours").alias("total_hours"),
            F.sum("non_productive_time").alias("non_productive_time"),
            F.sum("total_ot_hours").alias("total_ot_hours")]


def _pct() -> Column:
    return bi.field_time_ratio(F.col("field_work_time"), F.col("total_hours"),
                               F.col("non_productive_time"), F.col("total_ot_hours"))


def field_time_pct(labour: DataFrame, keys: list[str]) -> DataFrame:
    """B3 / A8 per group of ``keys``."""
    return labour.groupBy(*keys).agg(*_sums()).select(*keys, _pct().alias("field_time_pct"))


def with_role_target(labour: DataFrame) -> DataFrame:
    """B5 per row."""
    return labour.withColumn("target", bi.role_target(F.col("job_level")))


def with_period_bucket(labour: DataFrame, today: Column) -> DataFrame:
    """B4 per row."""
    return labour.withColumn("period", bi.period_bucket(F.col("calendar_day"), today))


def labour_kpi(labour: DataFrame, today: Column) -> DataFrame:
    """Per (job level, month): percent, MIN(target), RAG, period bucket and current-month label."""
    month = F.trunc("calendar_day", "MM")
    g = (with_role_target(labour)
         .groupBy("job_level", month.alias("month_start"))
         .agg(*_sums(), F.min("target").alias("target")))
    pct = _pct()
    return g.select(
        "job_level", "month_start",
        bi.month_year_text(F.col("month_start")).alias("month_year_text"),
        pct.alias("field_time_pct"), "target",
        bi.utilisation_rag(pct, F.col("target")).alias("rag"),
        bi.period_bucket(F.col("month_start"), today).alias("period"),
        bi.current_month_label(bi.month_year_text(F.col("month_start")), pct, today)
          .alias("current_month_label"))
