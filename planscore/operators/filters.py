"""Row filters over work-item facts.

All are plain predicates, so Catalyst pushes them as far down as the inputs allow; none of them
needs a join. Cohort tests use ``isin`` on the configured (bounded) lists, which compiles to an
in-set test in generated code; :func:`cohort_semi` / :func:`cohort_anti` give the join form for
cohorts kept as tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planscore.params import ProgramRules, ReportParams


def in_year(c: Column | str, year: int) -> Column:
    """``year(c) = year`` as a date range (same NULL behaviour, range form is prunable)."""
    c = F.col(c) if isinstance(c, str) else c
    return (c >= F.lit(dt.date(year, 1, 1))) & (c < F.lit(dt.date(year + 1, 1, 1)))


def tracked(rules: ProgramRules) -> Column:
    p = F.col("program")
    return p.isNotNull() & (p != rules.untracked)


def not_cancelled(rules: ProgramRules) -> Column:
    """Cancelled rows go, except for the exempt program. A NULL user status drops the row unless
    the program is exempt (three-valued logic of ``NOT LIKE``)."""
    p = F.col("program")
    live = ~F.col("user_status").contains(rules.cancel_marker)
    return (live & (p != rules.cancel_exempt)) | (p == rules.cancel_exempt)


def reference_complete(params: ReportParams, rules: ProgramRules) -> Column:
    return (in_year("reference_date", params.year)
            & (F.col("status") == rules.complete_status))


def year_eligible(params: ReportParams, rules: ProgramRules) -> Column:
    return ((F.col("reporting_year") == params.year)
            | in_year("report_date", params.year)
            | (reference_complete(params, rules)
               & F.col("program").isin(*rules.reference_cohort)))


def report_scope(params: ReportParams, rules: ProgramRules) -> Column:
    """the rows the report aggregates."""
    return tracked(rules) & not_cancelled(rules) & year_eligible(params, rules)


def filter_tracked(wi: DataFrame, rules: ProgramRules) -> DataFrame:
    return wi.filter(tracked(rules))


def filter_cancelled_exempt(wi: DataFrame, rules: ProgramRules) -> DataFrame:
    return wi.filter(not_cancelled(rules))


def filter_year_eligible(wi: DataFrame, params: ReportParams, rules: ProgramRules) -> DataFrame:
    return wi.filter(year_eligible(params, rules))


def cohort_table(spark, programs) -> DataFrame:
    """A configured cohort as a one-column table (size = the configured list)."""
    return spark.createDataFrame([(p,) for p in programs], "program string")


def cohort_semi(wi: DataFrame, cohort: DataFrame) -> DataFrame:
    """Rows whose program is in the cohort. The cohort is a configured list, so broadcasting it is
    bounded by configuration, not by data."""
    return wi.join(F.broadcast(cohort), "program", "left_semi")


def cohort_anti(wi: DataFrame, cohort: DataFrame) -> DataFrame:
    """Rows whose program is ``NOT IN`` the cohort: a NULL program compares as unknown and is
    dropped. The cohort is a configured list without NULLs."""
    return wi.filter(F.col("program").isNotNull()).join(F.broadcast(cohort), "program",
                                                        "left_anti")


def filter_label_year(uf: DataFrame, params: ReportParams) -> DataFrame:
    """Unit-forecast rows whose date-range label mentions the report year."""
    return uf.filter(F.col("date_range").contains(str(params.year)))


def filter_week(wt: DataFrame, week: int) -> DataFrame:
    return wt.filter((F.col("week") == week) & F.col("program").isNotNull())
