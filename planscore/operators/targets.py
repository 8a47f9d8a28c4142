"""Plan side of the report: weekly targets (A3), look-ahead schedule targets (A4) and
rebaselines (A5, F11, J3).

All inputs here are pre-aggregated per (program, week) by their producers, so every aggregation
below is a hash aggregate with a map-side partial step over at most programs x months groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planscore.operators.filters import filter_label_year, filter_week
from planscore.params import ProgramRules, ReportParams

TARGET_KEYS = ("program", "week", "month2", "month")


def targets_at_week(wt: DataFrame, params: ReportParams, rules: ProgramRules) -> DataFrame:
    """A3 + A3b: the week's targets per (program, week, month2, month). A week that spans two
    months gives two rows per program. ``ytd_completions`` is the external nickname's
    completions, NULL for groups without that nickname (no ELSE in the sum)."""
    zero = F.lit(0.0)
    return filter_week(wt, params.week).groupBy(*TARGET_KEYS).agg(
        F.sum(F.coalesce("initiation_ytd_target", zero)).alias("initiation_target"),
        F.sum(F.coalesce("design_ytd_target", zero)).alias("design_target"),
        F.sum(F.coalesce("dependency_ytd_target", zero)).alias("dependency_target"),
        F.sum(F.coalesce("execute_ytd_target", zero)).alias("execute_target"),
        F.sum(F.when(F.col("nickname") == rules.external_nickname,
                     F.coalesce("ytd_completions", zero))).alias("ytd_completions"),
    )


def program_targets(wt: DataFrame, params: ReportParams, rules: ProgramRules) -> DataFrame:
    """A3, A3b and A4 in one pass: one row per program that has targets in any week, with
    ``week_rows`` (the rows of :func:`targets_at_week`) and ``schedule_rows`` (those of
    :func:`schedule_targets`) as arrays.

    Every task pre-aggregates to at most programs x (months of two weeks + 1) rows; the arrays hold
    one entry per month that a week spans."""
    zero = F.lit(0.0)
    kind = (F.when(F.col("week") == params.week, "week")
            .when(F.col("week") == params.lookahead_week(), "lookahead"))
    keyed = wt.filter(F.col("program").isNotNull()).withColumn("kind", kind)
    cells = keyed.groupBy(
        "program", "kind", *[F.when(F.col("kind").isNotNull(), F.col(c)).alias(c)
                             for c in ("month2", "month")]).agg(
        *[F.sum(F.coalesce(f"{t}_ytd_target", zero)).alias(f"{t}_target")
          for t in ("initiation", "design", "dependency", "execute")],
        F.sum(F.when(F.col("nickname") == rules.external_nickname,
                     F.coalesce("ytd_completions", zero))).alias("ytd_completions"),
        F.sum("execute_ytd_forecast").alias("schedule_target"))
    return cells.groupBy("program").agg(
        F.collect_list(F.when(F.col("kind") == "week", F.struct(
            "initiation_target", "design_target", "dependency_target", "execute_target",
            "ytd_completions"))).alias("week_rows"),
        F.collect_list(F.when(F.col("kind") == "lookahead", F.struct("schedule_target")))
         .alias("schedule_rows"))


def nickname_completions(wt: DataFrame, params: ReportParams,
                         rules: ProgramRules) -> DataFrame:
    return targets_at_week(wt, params, rules).select(*TARGET_KEYS, "ytd_completions")


def schedule_targets(wt: DataFrame, params: ReportParams) -> DataFrame:
    """A4: execute forecast four weeks ahead, NULLs not coalesced."""
    return (filter_week(wt, params.lookahead_week())
            .groupBy("program", "month2", "month")
            .agg(F.sum("execute_ytd_forecast").alias("schedule_target")))


def normalize_nickname(nickname: Column, rules: ProgramRules) -> Column:
    """nickname -> program through the configured map (a handful of pairs, compared under
    the input's collation), identity otherwise."""
    out = None
    for nick, program in rules.nickname_map:
        out = (F.when(nickname == nick, F.lit(program)) if out is None
               else out.when(nickname == nick, F.lit(program)))
    return nickname if out is None else out.otherwise(nickname)


def rebaseline_by_nickname(uf: DataFrame, params: ReportParams,
                           rules: ProgramRules) -> DataFrame:
    """A5: rebaselines of the report year summed per nickname, then mapped to programs. Not
    re-summed per program: a program with two nicknames keeps two rows."""
    g = (filter_label_year(uf, params).groupBy("nickname")
         .agg(F.sum(F.coalesce("rebaseline", F.lit(0.0))).alias("rebaseline")))
    return g.select("nickname", normalize_nickname(F.col("nickname"), rules).alias("program"),
                    "rebaseline")


def rebaselines(uf: DataFrame, wt: DataFrame, params: ReportParams,
                rules: ProgramRules, resum: bool = False) -> DataFrame:
    """Keep rebaselines of programs that have targets, then DISTINCT (program, value).

    The report writes an inner join + DISTINCT; since only rebaseline columns are kept, a
    semi-join + DISTINCT is the same set and never multiplies rows by target rows.
    ``resum=True`` sums the nicknames of a program into one row (the report does not)."""
    reb = rebaseline_by_nickname(uf, params, rules)
    progs = wt.select("program").where(F.col("program").isNotNull())
    kept = reb.join(progs, "program", "left_semi")
    if resum:
        return kept.groupBy("program").agg(F.sum("rebaseline").alias("rebaseline"))
    return kept.select("program", "rebaseline").distinct()


def rebaselines_inner_distinct(uf: DataFrame, wt: DataFrame, params: ReportParams,
                               rules: ProgramRules) -> DataFrame:
    """J3 literally (inner join, then DISTINCT); for equivalence tests."""
    reb = rebaseline_by_nickname(uf, params, rules)
    return (reb.join(wt.select("program"), "program", "inner")
            .select("program", "rebaseline").distinct())
