"""Scorecard measure rules M1-M10 as Column expressions.

``raw`` is the unrounded target (always the divisor), ``actual`` the program actual (may be
NULL), ``program`` the program column. Divisions use ``try_divide`` so a zero target yields NULL
instead of an error; a NULL ratio falls through to GREEN, as in the report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from planscore.params import ProgramRules, ReportParams

def ZERO() -> Column:
    return F.lit(0.0)


def ONE() -> Column:
    return F.lit(1.0)


def plan_v1(raw: Column) -> Column:
    """M1: target rounded to a whole number (half away from zero)."""
    return F.round(raw, 0)


def plan_v3(raw: Column, program: Column, rules: ProgramRules) -> Column:
    """M2: two decimals for the fractional program, whole numbers otherwise."""
    return F.when(program == rules.fractional_program, F.round(raw, 2)).otherwise(F.round(raw, 0))


def completions_v1(actual: Column) -> Column:
    """M3: missing actual counts as 0."""
    return F.coalesce(actual, ZERO())


def completions_v4(actual: Column, program: Column, rules: ProgramRules) -> Column:
    """M4: M3, with two decimals for the fractional program."""
    a = F.coalesce(actual, ZERO())
    return F.when(program == rules.fractional_program, F.round(a, 2)).otherwise(a)


def round_fractional(value: Column, program: Column, rules: ProgramRules) -> Column:
    """M4 for the informational phases: not coalesced, rounded for the fractional program."""
    return F.when(program == rules.fractional_program, F.round(value, 2)).otherwise(value)


def pct_v1(raw: Column, actual: Column) -> Column:
    """M5: target > 0 with no actual -> 0; zero (or missing) target -> 1; else the ratio to 4
    decimals (negative targets fall through to the ratio)."""
    t = F.coalesce(raw, ZERO())
    return (F.when((t > 0) & (F.coalesce(actual, ZERO()) == 0), ZERO())
            .when(t == 0, ONE())
            .otherwise(F.round(F.try_divide(actual, t), 4)))


def pct_v2(raw: Column, actual: Column) -> Column:
    """M6: zero (or missing) target -> 0; else coalesced actual / target to 4 decimals."""
    return (F.when(F.coalesce(raw, ZERO()) == 0, ZERO())
            .otherwise(F.round(F.try_divide(F.coalesce(actual, ZERO()), raw), 4)))


def pct_v4(raw: Column, actual: Column, program: Column, rules: ProgramRules) -> Column:
    """M7: M6, but the fractional program divides its two-decimal actual."""
    a = F.coalesce(actual, ZERO())
    a = F.when(program == rules.fractional_program, F.round(a, 2)).otherwise(a)
    return (F.when(F.coalesce(raw, ZERO()) == 0, ZERO())
            .otherwise(F.round(F.try_divide(a, raw), 4)))


def rag_ratio(raw: Column, actual: Column) -> Column:
    """Ratio the RAG compares: coalesced actual over a non-zero target, two decimals."""
    t = F.coalesce(raw, ZERO())
    return F.round(F.try_divide(F.coalesce(actual, ZERO()), F.nullif(t, ZERO())), 2)


def rag_threshold(raw: Column, actual: Column, params: ReportParams,
                  black: Column | None = None) -> Column:
    """M8 (+ M9 when ``black`` is given): above max or below min -> RED, else GREEN (no amber;
    a NULL ratio is GREEN). ``black`` marks exempt programs, shown BLACK."""
    r = rag_ratio(raw, actual)
    rag = (F.when(r > F.lit(float(params.rag_max)), F.lit("RED"))
           .when(r < F.lit(float(params.rag_min)), F.lit("RED"))
           .otherwise(F.lit("GREEN")))
    if black is not None:
        rag = F.when(black, F.lit("BLACK")).otherwise(rag)
    return rag


def black_override(phase: Column, program: Column, rules: ProgramRules) -> Column:
    """M9: exempt programs per phase (design list, dependencies list)."""
    return (((phase == "Design") & program.isin(*rules.design_black))
            | ((phase == "Dependencies") & program.isin(*rules.dependency_black)))
