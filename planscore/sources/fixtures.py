"""Input views of the report rebuilt from the TPC-H-style test tables (FIXTURES.md §4).

The report reads six upstream views whose definitions are not available; these functions derive
DataFrames with the same columns and roles. Each join here is keyed (no products), the large
joins are left to the planner (sort-merge at scale, broadcast under AQE when a side is small), and
the dimension joins are ordered so that the lineitem-sized stream is shuffled as few times as
possible: orders meets customer/nation/region first; lineitem meets part, then orders.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planscore.sources.tables import Tables

FIXTURE_YEAR = 1998


def _ts_bound(df: DataFrame, col: str, day: dt.date) -> Column:
    """Literal of the column's own timestamp type, so the comparison reaches the parquet scan."""
    return F.lit(day.isoformat()).cast(df.schema[col].dataType)


def year_range(df: DataFrame, col: str, year: int) -> Column:
    """``year(col) = year`` written as a range, which parquet pushdown understands."""
    return ((F.col(col) >= _ts_bound(df, col, dt.date(year, 1, 1)))
            & (F.col(col) < _ts_bound(df, col, dt.date(year + 1, 1, 1))))


def _units(brand: Column) -> Column:
    # Brand#9 is the fractional program: its units are multiples of 1/128, so that rounding its
    # actuals to two decimals shows in the fourth decimal of its percentages.
    return F.col("l_quantity") * F.when(brand == "Brand#9", F.lit(0.0078125)).otherwise(
        F.lit(1.0))


def _target_scale(brand: Column) -> Column:
    """Targets relative to the year's units, by brand number: 1, 3/8 or 1/4, so that completion
    ratios fall below, inside and above the threshold band."""
    third = F.regexp_extract(brand, r"(\d+)$", 1).cast("int") % 3
    return F.when(third == 0, 1.0).when(third == 1, 0.375).otherwise(0.25)


def _orders_with_geo(t: Tables) -> DataFrame:
    geo = (t.customer.select("c_custkey", "c_nationkey")
           .join(t.nation.select("n_nationkey", "n_name", "n_regionkey"),
                 F.col("c_nationkey") == F.col("n_nationkey"))
           .join(t.region.select("r_regionkey", "r_name"),
                 F.col("n_regionkey") == F.col("r_regionkey")))
    return (t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
            .join(geo, F.col("o_custkey") == F.col("c_custkey")))


def work_items(t: Tables, lineitem: DataFrame | None = None) -> DataFrame:
    """Work-item facts. ``lineitem`` may be a streaming DataFrame (stream-static joins)."""
    li = lineitem if lineitem is not None else t.lineitem
    li = li.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag",
                   "l_linestatus", "l_shipdate")
    part = t.part.select("p_partkey", "p_brand", "p_type", "p_size")
    # Part first: program predicates (and the cancellation test, which needs the program) then
    # apply before the second shuffle, and the result leaves partitioned by order key, which is
    # the notification key, so the notification-grain aggregation needs no shuffle of its own.
    j = (li.join(part, F.col("l_partkey") == F.col("p_partkey"))
         .join(_orders_with_geo(t), F.col("l_orderkey") == F.col("o_orderkey")))
    odate = F.col("o_orderdate").cast("date")
    ship = F.col("l_shipdate").cast("date")
    closed = F.col("l_linestatus") == "F"
    u = _units(F.col("p_brand"))
    return j.select(
        F.when(F.col("p_partkey") % 97 == 0, F.lit(None).cast("string"))
         .when(F.col("p_brand") == "Brand#25", F.lit("UNTRACKED"))
         .otherwise(F.col("p_brand")).alias("program"),
        F.col("p_type").alias("sub_program"),
        F.col("l_orderkey").alias("notification"),
        F.col("l_linenumber").alias("work_order"),
        F.col("p_size").alias("mat"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("division"),
        F.col("o_orderpriority").alias("funding_action"),
        F.year("o_orderdate").cast("int").alias("reporting_year"),
        odate.alias("work_plan_date"),
        ship.alias("report_date"),
        F.when(closed, odate).alias("reference_date"),
        F.when(closed, F.lit("COMP")).otherwise(F.lit("OPEN")).alias("status"),
        F.when(F.col("l_returnflag") == "R", F.lit("RDY CNCL"))
         .when(F.col("l_returnflag") == "A", F.lit("RDY"))
         .when(F.col("l_linenumber") >= 3, F.lit(None).cast("string"))
         .otherwise(F.lit("WIP")).alias("user_status"),
        F.when(F.col("l_linenumber") == 2, F.lit(None).cast("date")).otherwise(odate)
         .alias("initiation_out"),
        F.date_add(odate, 20).alias("design_out"),
        F.date_add(odate, 40).alias("dependency_out"),
        F.date_add(odate, 60).alias("schedule_out"),
        # a point in time, as scheduling tools store it
        (F.col("l_shipdate").cast("date").cast("timestamp_ntz") + F.expr("INTERVAL 15 HOURS"))
        .alias("click_end_date"),
        ship.alias("execute_out"),
        u.alias("initiation_actuals"),
        F.when(F.col("p_brand") == "Brand#7", F.lit(None).cast("double")).otherwise(u)
         .alias("design_actuals"),
        u.alias("dependency_actuals"),
        u.alias("schedule_actuals"),
        u.alias("execute_actuals"),
        u.alias("in_workplan"),
    )


def plan_calendar_weeks(year: int) -> Column:
    """(week, month) pairs of a plan year as one array expression: ISO week of every day of the
    year, deduplicated in date order. At most 53 x 2 entries, independent of the data, and
    constant-folded by the optimizer."""
    days = F.sequence(F.lit(dt.date(year, 1, 1)), F.lit(dt.date(year, 12, 31)))
    return F.array_distinct(F.transform(
        days, lambda d: F.struct(F.weekofyear(d).alias("week"), F.month(d).alias("month"))))


def weekly_targets(t: Tables, year: int = FIXTURE_YEAR) -> DataFrame:
    """One row per (program, nickname, week, month): running year-to-date units of the nickname.

    Every nickname carries the whole plan calendar (a generator over a bounded, data-independent
    array, not a join), and its sales are attached by a keyed left join."""
    orders = t.orders.select("o_orderkey", "o_orderdate")
    orders = orders.filter(year_range(orders, "o_orderdate", year))
    part = t.part.select("p_partkey", "p_brand", "p_type")
    nickname = F.concat(F.col("p_brand"), F.lit(" "), F.col("p_type"))
    sales = (t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
             .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
             .join(part, F.col("l_partkey") == F.col("p_partkey"))
             .groupBy(nickname.alias("nickname"),
                      F.weekofyear("o_orderdate").cast("int").alias("week"),
                      F.month("o_orderdate").cast("int").alias("month"))
             .agg(F.sum(_units(F.col("p_brand"))).alias("q")))
    grid = (part.select(F.col("p_brand").alias("program"), nickname.alias("nickname")).distinct()
            .select("program", "nickname", F.explode(plan_calendar_weeks(year)).alias("wm"))
            .select("program", "nickname", F.col("wm.week").alias("week"),
                    F.col("wm.month").alias("month")))
    run = Window.partitionBy("program", "nickname").orderBy("week", "month") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ytd = (grid.join(sales, ["nickname", "week", "month"], "left")
           .select("program", "nickname", "week", "month",
                   (F.sum(F.coalesce(F.col("q"), F.lit(0.0))).over(run)
                    * _target_scale(F.col("program"))).alias("ytd")))
    p = F.col("program")
    return ytd.select(
        "program", "nickname", "week", "month",
        F.concat(F.lit("M"), F.col("month").cast("string")).alias("month2"),
        F.col("ytd").alias("initiation_ytd_target"),
        F.when(p.isin("Brand#7", "Brand#8"), F.lit(0.0)).otherwise(F.col("ytd"))
         .alias("design_ytd_target"),
        F.when(p == "Brand#8", F.lit(None).cast("double")).otherwise(F.col("ytd"))
         .alias("dependency_ytd_target"),
        F.col("ytd").alias("execute_ytd_target"),
        F.col("ytd").alias("execute_ytd_forecast"),
        F.col("ytd").alias("ytd_completions"),
    )


def unit_forecast(t: Tables, year: int | None = None) -> DataFrame:
    """Unit forecasts with their week label. The label derives from the order date, so a year
    asked for also prunes the orders scan."""
    orders = t.orders.select("o_orderkey", "o_orderdate")
    if year is not None:
        orders = orders.filter(year_range(orders, "o_orderdate", year))
    part = t.part.select("p_partkey", "p_brand", "p_size")
    j = (t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
         .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(part, F.col("l_partkey") == F.col("p_partkey")))
    b = F.col("p_brand")
    return j.select(
        F.when((b == "Brand#1") & (F.col("p_size") < 25), F.lit("M Brand#1 A"))
         .when(b == "Brand#1", F.lit("M Brand#1 B"))
         .when(b == "Brand#2", F.lit("C Brand#2"))
         .when(b == "Brand#3", F.lit("No Such Program"))
         .otherwise(b).alias("nickname"),
        F.concat(F.lit("Wk "), F.weekofyear("o_orderdate").cast("string"), F.lit(" "),
                 F.year("o_orderdate").cast("string")).alias("date_range"),
        F.when(F.col("l_linenumber") == 1, F.lit(None).cast("double"))
         .otherwise(F.col("l_quantity")).alias("rebaseline"),
    )


def week_lookup(t: Tables, year: int = FIXTURE_YEAR) -> DataFrame:
    """Weeks of the plan with their months and date range (first and last day of the year in that
    week and month)."""
    days = F.sequence(F.lit(dt.date(year, 1, 1)), F.lit(dt.date(year, 12, 31)))
    span = F.filter(days, lambda d: (F.weekofyear(d) == F.col("week"))
                    & (F.month(d) == F.col("month")))
    return (weekly_targets(t, year).select("week", "month", "month2").distinct()
            .withColumn("date_range", F.concat_ws(
                " - ", F.array_min(span).cast("string"), F.array_max(span).cast("string"))))


def finance_rows(t: Tables) -> DataFrame:
    seg = F.col("c_mktsegment")
    nk = F.col("n_nationkey") % 5
    j = (t.orders.select("o_custkey", "o_orderdate", "o_totalprice")
         .join(t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"),
               F.col("o_custkey") == F.col("c_custkey"))
         .join(t.nation.select("n_nationkey", "n_name"),
               F.col("c_nationkey") == F.col("n_nationkey")))
    g = (j.groupBy("n_name", "n_nationkey", "c_mktsegment",
                   (F.month("o_orderdate").cast("int") % 3).alias("m3"))
         .agg(F.sum(F.floor("o_totalprice")).alias("s")))
    s = F.col("s").cast("double")
    return g.select(
        F.col("n_name").alias("line"),
        F.when(seg == "AUTOMOBILE", F.lit("Capital")).when(seg == "BUILDING", F.lit("Expense"))
         .when(seg == "FURNITURE", F.lit("Non-Core/ Other Bal Sheet"))
         .when(seg == "MACHINERY", F.lit("Non-EIE")).otherwise(F.lit("Unclassified"))
         .alias("category"),
        F.when(F.col("m3") == 0, F.lit("EOY")).when(F.col("m3") == 1, F.lit("YTD"))
         .otherwise(F.lit("MTD")).alias("period"),
        s.alias("actual"),
        # blank for one category of the lines without a budget: one value plus blanks per period
        (s * F.when(nk == 0, F.lit(128.0))
         .when(nk == 1, F.when(seg == "AUTOMOBILE", F.lit(None)).otherwise(F.lit(0.0)))
         .otherwise(F.lit(0.5))).alias("budget"),
        # one value for all rows of some lines
        F.when(nk == 4, F.lit(6000000.0)).otherwise(
            s * F.when(nk == 0, F.lit(-127.0)).when(nk == 2, F.lit(64.0)).otherwise(F.lit(0.5)))
         .alias("variance"),
    )


def labour_by_day(t: Tables) -> DataFrame:
    ev = t.events.select("ts", "user_id", "event_type", "value")
    v = F.floor("value").cast("double")
    et = F.col("event_type")
    lvl = F.col("user_id") % 4
    return (ev.groupBy(F.col("ts").cast("date").alias("calendar_day"), "user_id")
            .agg(F.sum(F.when(et == "view", v).otherwise(F.lit(0.0))).alias("field_work_time"),
                 F.sum(v).alias("total_hours"),
                 F.sum(F.when(et == "error", v).otherwise(F.lit(0.0))).alias("non_productive_time"),
                 F.sum(F.when(et == "signup", v).otherwise(F.lit(0.0))).alias("total_ot_hours"))
            .select("calendar_day", "user_id",
                    F.when(lvl == 0, F.lit("Supervisor")).when(lvl == 1, F.lit("Manager"))
                     .when(lvl == 2, F.lit("Senior Leader")).otherwise(F.lit("Other"))
                     .alias("job_level"),
                    "field_work_time", "total_hours", "non_productive_time", "total_ot_hours"))


def calendar(t: Tables) -> DataFrame:
    """Date dimension over the span of the order dates (S4/S10): one global min/max, then a
    generator bounded by the number of days in that span."""
    span = t.orders.agg(F.min("o_orderdate").cast("date").alias("d0"),
                        F.max("o_orderdate").cast("date").alias("d1"))
    days = span.select(F.explode(F.sequence("d0", "d1")).alias("calendar_date"))
    d = F.col("calendar_date")
    return days.select(
        d,
        F.year(d).alias("calendar_year"),
        F.month(d).alias("calendar_month"),
        F.weekofyear(d).alias("calendar_week"),
        F.date_format(d, "MM-yyyy").alias("month_year_text"),
        (F.weekday(d) < 5).alias("is_business_day"),
    )


def write_inputs(t: Tables, root: str, year: int = FIXTURE_YEAR) -> dict[str, str]:
    """Store the report's inputs as parquet tables under ``root`` (as a deployment would hold
    them) and return their paths."""
    paths = {}
    for name, df in (("work_items", work_items(t)), ("weekly_targets", weekly_targets(t, year)),
                     ("unit_forecast", unit_forecast(t, year)), ("calendar", calendar(t))):
        paths[name] = f"{root.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(paths[name])
    return paths
