"""BI measures B1-B6 as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the BI rules: role targets, variance limits per category, colour codes,
# periods the variance colour applies to, and the ratio threshold.
ROLE_TARGETS = (("Supervisor", 0.5), ("Manager", 0.25), ("Senior Leader", 0.15))
VARIANCE_LIMITS = (("Capital", 10000000.0), ("Expense", 5000000.0),
                   ("Non-Core/ Other Bal Sheet", 5000000.0), ("Non-EIE", 5000000.0))
VARIANCE_PERIODS = ("EOY", "YTD")
VARIANCE_RATIO = 0.02
RED_HEX, GREEN_HEX, AMBER_HEX = "#FF0000", "#00FF00", "#FFA500"


def field_time_ratio(field: Column, total: Column, nonproductive: Column,
                     overtime: Column) -> Column:
    """B3 / A8 over already-summed inputs: field / (total - non-productive - overtime), blank
    (NULL) when the denominator is 0."""
    return F.try_divide(field, total - nonproductive - overtime)


def role_target(job_level: Column) -> Column:
    """Target share by role, NULL for other roles."""
    out = None
    for role, target in ROLE_TARGETS:
        out = (F.when(job_level == role, F.lit(target)) if out is None
               else out.when(job_level == role, F.lit(target)))
    return out.otherwise(F.lit(None).cast("double"))


def utilisation_rag(pct: Column, target: Column) -> Column:
    """Below target -> RED, else GREEN (NULL percent or target -> GREEN)."""
    return F.when(pct < target, F.lit("RED")).otherwise(F.lit("GREEN"))


def month_index(d: Column) -> Column:
    return F.year(d) * 12 + F.month(d)


def period_bucket(day: Column, today: Column) -> Column:
    """Month-boundary difference (not elapsed months): 0 -> This Month, < 0 -> Actuals,
    > 0 -> Future."""
    diff = month_index(day) - month_index(today)
    return (F.when(diff == 0, F.lit("This Month")).when(diff < 0, F.lit("Actuals"))
            .otherwise(F.lit("Future")))


def month_year_text(d: Column) -> Column:
    return F.date_format(d, "MM-yyyy")


def percent_text(x: Column) -> Column:
    """``FORMAT(x, "0.00%")``; a blank stays blank (Java would print ``nu%`` for NULL)."""
    return F.when(x.isNotNull(), F.format_string("%.2f%%", x * 100))


def current_month_label(month_text: Column, pct: Column, today: Column) -> Column:
    """B2: the formatted percent on rows of the current month, blank (NULL) elsewhere.
    Formatting a blank percent gives an empty string, as DAX ``FORMAT`` does."""
    return F.when(month_text == month_year_text(today),
                  F.coalesce(percent_text(pct), F.lit("")))


def variance_limit(category: Column) -> Column:
    out = None
    for cat, limit in VARIANCE_LIMITS:
        out = (F.when(category == cat, F.lit(limit)) if out is None
               else out.when(category == cat, F.lit(limit)))
    return out


def variance_color(category: Column, period: Column, actual: Column, budget: Column,
                   variance: Column) -> Column:
    """B1 with DAX arithmetic on blanks: a blank actual makes the ratio blank, which compares as
    0 (so ``< 0.02`` holds); actual / blank-or-zero budget is infinite (``>= 0.02`` holds) unless
    the actual is 0 (0 / 0 is NaN: neither test holds). A blank variance compares as 0.
    Unlisted categories and periods: amber."""
    b = F.coalesce(budget, F.lit(0.0))
    v = F.coalesce(variance, F.lit(0.0))
    ratio = F.abs(F.try_divide(actual, b))
    big_ratio = (F.when(actual.isNull(), F.lit(False)).when(b != 0, ratio >= VARIANCE_RATIO)
                 .otherwise(actual != 0))
    small_ratio = (F.when(actual.isNull(), F.lit(True)).when(b != 0, ratio < VARIANCE_RATIO)
                   .otherwise(F.lit(False)))
    limit = variance_limit(category)
    in_period = period.isin(*VARIANCE_PERIODS)
    return (F.when(in_period & (v >= limit) & big_ratio, F.lit(RED_HEX))
            .when(in_period & (v < limit) & small_ratio, F.lit(GREEN_HEX))
            .otherwise(F.lit(AMBER_HEX)))
