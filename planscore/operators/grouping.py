"""Group-level helpers of the BI measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def selected_value_aggs(col: str) -> list[Column]:
    """A7 (DAX ``SELECTEDVALUE``) as algebraic aggregates: the group's value if it holds exactly
    one distinct value (a blank counts as a value), else the alternate.

    Built from min / max / count only, so it pre-aggregates map-side and a hot group is just a
    larger partial sum. Returns helper aggregates; finish with :func:`selected_value_result`."""
    name = col
    c = F.col(col)
    return [F.min(c).alias(f"__{name}_min"), F.max(c).alias(f"__{name}_max"),
            F.count(c).alias(f"__{name}_n"), F.count(F.lit(1)).alias(f"__{name}_rows")]


def selected_value_result(name: str, alt: Column | None = None) -> Column:
    mn, mx = F.col(f"__{name}_min"), F.col(f"__{name}_max")
    n, rows = F.col(f"__{name}_n"), F.col(f"__{name}_rows")
    single = ((n == rows) & (mn == mx)) | (n == 0)
    alt = alt if alt is not None else F.lit(None)
    return F.when(single, mx).otherwise(alt).alias(name)


def selected_values(df: DataFrame, keys: list[str], cols: list[str],
                    alts: dict[str, Column] | None = None) -> DataFrame:
    """One row per group with the selected value of each column."""
    alts = alts or {}
    aggs = [a for c in cols for a in selected_value_aggs(c)]
    g = df.groupBy(*keys).agg(*aggs)
    # Alternates may name other selected columns: resolve plain values first.
    plain = g.select(*keys, *[selected_value_result(c) for c in cols if c not in alts],
                     *[F.col(f"__{c}_{x}") for c in alts for x in ("min", "max", "n", "rows")])
    return plain.select(*keys, *[F.col(c) if c not in alts else
                                 selected_value_result(c, alts[c]) for c in cols])


def selected_value_states(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """One mergeable state per finest group: least and greatest value, values and rows of each
    column (the keys' own included, as a rolled-up level may hold one of them or several)."""
    names = list(dict.fromkeys([*keys, *cols]))
    return df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(
        *[a for c in names for a in selected_value_aggs(c)])


def selected_values_levels(states: DataFrame, keys: list[str], cols: list[str],
                           levels: list[list[str]]) -> DataFrame:
    """Selected values at several group levels in one aggregation: the states of
    :func:`selected_value_states` merge upwards, so the rows are read once whatever the number of
    levels. Columns: ``level`` (bit per key, first key highest, 1 where it is rolled up), then the
    selected value of every key and column at that level."""
    names = list(dict.fromkeys([*keys, *cols]))
    merge = {"min": F.min, "max": F.max, "n": F.sum, "rows": F.sum}
    merged = [fn(f"__{c}_{x}").alias(f"__{c}_{x}") for c in names for x, fn in merge.items()]
    own = [f"_key_{k}" for k in keys]
    g = states.groupingSets([[f"_key_{k}" for k in level] for level in levels], *own).agg(
        F.grouping_id().cast("long").alias("level"), *merged)
    return g.select("level", *[selected_value_result(c) for c in names])
