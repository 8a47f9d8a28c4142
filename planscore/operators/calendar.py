"""Business-day calendar windows (W1-W3) and the run gate.

Windows are partitioned by (year, month) or (year, week): at most 23 rows per partition, and the
``row_number() = n`` filter is planned as a WindowGroupLimit, so each partition stops after n
rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nth_business_day_of_month(cal: DataFrame, n: int = 5) -> DataFrame:
    """The n-th business day of every month in the calendar (months with fewer business days
    have none)."""
    w = Window.partitionBy("calendar_year", "calendar_month").orderBy("calendar_date")
    return (cal.filter(F.col("is_business_day"))
            .withColumn("business_day_number", F.row_number().over(w))
            .filter(F.col("business_day_number") == n)
            .select("calendar_date", "calendar_year", "calendar_month", "business_day_number"))


def nth_business_day_of_week(cal: DataFrame, year: int, n: int = 1) -> DataFrame:
    """The n-th business day of each calendar week within one year. Partitioned by week only,
    as the gate it comes from; ordered by date (the original ordering key was constant within
    the partition, which leaves the pick undefined)."""
    w = Window.partitionBy("calendar_week").orderBy("calendar_date")
    return (cal.filter(F.col("is_business_day") & (F.col("calendar_year") == year))
            .withColumn("business_day_number", F.row_number().over(w))
            .filter(F.col("business_day_number") == n)
            .select("calendar_date", "calendar_week", "business_day_number"))


def business_days_in_month(cal: DataFrame, today: dt.date | Column) -> DataFrame:
    """F8: business days of the month containing ``today`` (a date range, so it prunes)."""
    t = F.lit(today) if isinstance(today, dt.date) else today
    return cal.filter(F.col("is_business_day")
                      & (F.col("calendar_date") >= F.trunc(t, "MM"))
                      & (F.col("calendar_date") <= F.last_day(t)))


def business_day_gate(cal: DataFrame, today: dt.date | Column, n: int = 5) -> DataFrame:
    """J4's subquery: one row when ``today`` is the n-th business day of its month, else none."""
    t = F.lit(today) if isinstance(today, dt.date) else today
    month = business_days_in_month(cal, t)
    w = Window.partitionBy("calendar_year", "calendar_month").orderBy("calendar_date")
    return (month.withColumn("business_day_number", F.row_number().over(w))
            .filter((F.col("business_day_number") == n) & (F.col("calendar_date") == t))
            .select("calendar_date"))


def business_day_of_week_gate(cal: DataFrame, today: dt.date | Column, n: int = 1) -> DataFrame:
    """The week variant of J4: one row when ``today`` is the n-th business day of its calendar
    week, counted within today's year (days of the same ISO week in the other year do not
    count)."""
    t = F.lit(today) if isinstance(today, dt.date) else today
    days = cal.filter(F.col("is_business_day") & (F.col("calendar_year") == F.year(t))
                      & (F.col("calendar_week") == F.weekofyear(t)))
    w = Window.partitionBy("calendar_week").orderBy("calendar_date")
    return (days.withColumn("business_day_number", F.row_number().over(w))
            .filter((F.col("business_day_number") == n) & (F.col("calendar_date") == t))
            .select("calendar_date"))


def gated(report: DataFrame, gate: DataFrame) -> DataFrame:
    """Keep the report only if the gate has a row: an uncorrelated EXISTS, planned as a scalar
    subquery filter (no join). Gate off gives an empty result with the report's schema."""
    return report.filter(gate.exists())
