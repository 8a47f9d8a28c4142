"""BI measures, calendar windows, the run gate and the TSV sink on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from planscore.functions import bi
from planscore.operators.calendar import (business_day_gate, gated, nth_business_day_of_month,
                                          nth_business_day_of_week)
from planscore.operators.grouping import selected_values
from planscore.plans import finance, labour
from planscore.sources.sinks import read_report_tsv, write_report_tsv
from planscore.session import checkpoint_dir


def cal(spark, start, end):
    df = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("calendar_date"))
    d = F.col("calendar_date")
    return df.select(d, F.year(d).alias("calendar_year"), F.month(d).alias("calendar_month"),
                     F.weekofyear(d).alias("calendar_week"), (F.weekday(d) < 5).alias("is_business_day"))


def test_fifth_business_day(spark):
    got = [r.calendar_date for r in
           nth_business_day_of_month(cal(spark, dt.date(1998, 9, 1), dt.date(1998, 10, 31)), 5)
           .orderBy("calendar_date").collect()]
    assert got == [dt.date(1998, 9, 7), dt.date(1998, 10, 7)]


def test_month_with_fewer_business_days_has_none(spark):
    # 1998-02-25 .. 02-28: Wed, Thu, Fri, Sat -> three business days in the calendar.
    got = nth_business_day_of_month(cal(spark, dt.date(1998, 2, 25), dt.date(1998, 2, 28)), 5)
    assert got.count() == 0


def test_first_business_day_of_week_across_year_boundary(spark):
    # 1999-01-01 (Fri) belongs to ISO week 53: within 1999 it is that week's first business day.
    c = cal(spark, dt.date(1998, 12, 20), dt.date(1999, 1, 15))
    got = {r.calendar_week: r.calendar_date for r in nth_business_day_of_week(c, 1999, 1).collect()}
    assert got == {53: dt.date(1999, 1, 1), 1: dt.date(1999, 1, 4), 2: dt.date(1999, 1, 11)}


def test_gate_on_and_off(spark):
    c = cal(spark, dt.date(1998, 9, 1), dt.date(1998, 9, 30))
    report = spark.createDataFrame([("a", 1.0)], "k string, v double")
    assert gated(report, business_day_gate(c, dt.date(1998, 9, 7), 5)).count() == 1
    off = gated(report, business_day_gate(c, dt.date(1998, 9, 8), 5))
    assert off.count() == 0 and off.columns == ["k", "v"]


def test_selected_value(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", None), ("b", 5.0), ("c", 5.0),
                                ("c", 5.0), ("d", 1.0), ("d", 2.0)], "g string, x double")
    got = {r.g: r.x for r in selected_values(df, ["g"], ["x"]).collect()}
    assert got == {"a": None, "b": None, "c": 5.0, "d": None}


def test_variance_color(spark):
    rows = [("Capital", "EOY", 100.0, 1000.0, 2e7),      # |a/b| .1, var >= 10M -> red
            ("Capital", "YTD", 1.0, 1000.0, 1.0),        # small ratio, small var -> green
            ("Capital", "MTD", 1.0, 1000.0, 1.0),        # period not listed -> amber
            ("Expense", "EOY", 5.0, 0.0, 6e6),           # budget 0, actual -> infinite -> red
            ("Expense", "EOY", 0.0, 0.0, 1.0),           # 0 / 0 -> amber
            ("Non-EIE", "YTD", None, None, None),        # blank / blank is blank (= 0) -> green
            ("Non-EIE", "EOY", 0.0, None, None),         # 0 / blank is NaN -> amber
            ("Other", "EOY", 100.0, 1000.0, 2e7)]        # unknown category -> amber
    df = spark.createDataFrame(rows, "category string, period string, actual double, budget double, variance double")
    got = [r.c for r in df.select(bi.variance_color(*[F.col(c) for c in df.columns]).alias("c")).collect()]
    assert got == ["#FF0000", "#00FF00", "#FFA500", "#FF0000", "#FFA500", "#00FF00", "#FFA500",
                   "#FFA500"]
    # Per visual cell: the two (Expense, EOY) rows disagree, so their actual and variance are
    # blank; budget is a single 0. Blank ratio and blank variance compare as 0 -> green.
    per_cell = finance.variance_colors(df.withColumn("line", F.lit("x")), ["line", "category", "period"])
    got = {(r.category, r.period): r.color for r in per_cell.collect()}
    assert got == {("Capital", "EOY"): "#FF0000", ("Capital", "YTD"): "#00FF00",
                   ("Capital", "MTD"): "#FFA500", ("Expense", "EOY"): "#00FF00",
                   ("Non-EIE", "YTD"): "#00FF00", ("Non-EIE", "EOY"): "#FFA500",
                   ("Other", "EOY"): "#FFA500"}


def test_period_bucket_month_boundary(spark):
    df = spark.createDataFrame([(dt.date(1998, 1, 31),), (dt.date(1998, 2, 1),), (dt.date(1997, 12, 31),),
                                (dt.date(1998, 3, 1),)], "d date")
    got = [r.b for r in df.select(bi.period_bucket(F.col("d"), F.lit(dt.date(1998, 2, 28))).alias("b")).collect()]
    assert got == ["Actuals", "This Month", "Actuals", "Future"]


def test_labour_kpi(spark):
    rows = [(dt.date(2024, 1, 2), 1, "Supervisor", 2.0, 10.0, 1.0, 1.0),
            (dt.date(2024, 1, 3), 2, "Supervisor", 3.0, 4.0, 0.0, 0.0),
            (dt.date(2024, 1, 3), 3, "Manager", 1.0, 2.0, 1.0, 1.0),      # zero denominator
            (dt.date(2024, 2, 3), 4, "Other", 1.0, 2.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "calendar_day date, user_id long, job_level string, field_work_time double, "
                                     "total_hours double, non_productive_time double, total_ot_hours double")
    got = {(r.job_level, r.month_year_text): (r.field_time_pct, r.target, r.rag, r.period, r.current_month_label)
           for r in labour.labour_kpi(df, F.lit(dt.date(2024, 1, 20))).collect()}
    assert got == {("Supervisor", "01-2024"): (5.0 / 12.0, 0.5, "RED", "This Month", "41.67%"),
                   ("Manager", "01-2024"): (None, 0.25, "GREEN", "This Month", ""),
                   ("Other", "02-2024"): (0.5, None, "GREEN", "Future", None)}


def test_tsv_sink_roundtrip(spark, tmp_path):
    cols = ("output string, mega_process string, owner string, process string, program string, "
            "unit_of_measure string, phase string, plan double, completions double, pct_to_plan double, "
            "on_track string, rag string")
    rows = [("PDC", "Projects", "Owner P", None, "B", "", "Design", 10.0, 9.0, 0.9, "", "RED"),
            ("PDC", None, None, None, "A", "", "Annual Target", 3.0, 0.0, 0.0, "", "")]
    df = spark.createDataFrame(rows, cols)
    path = str(tmp_path / "report")
    write_report_tsv(df, path, single_file=True)
    text = "".join(open(p).read() for p in sorted((tmp_path / "report").glob("part-*")))
    lines = text.splitlines()
    assert lines[0].split("\t")[:3] == ["Output", "Mega Process", "MPO"]
    first = lines[1].split("\t")
    assert first[4] == "A" and first[3] == "NULL" and first[7:10] == ["3", "0", "0"]
    back = read_report_tsv(spark, path)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)
    assert checkpoint_dir(spark)


def test_selected_value_falls_back_to_forecast(spark):
    rows = [("Capital", "EOY", 1.0, 100.0, 2e7, 9.0),     # two actuals, one forecast -> forecast
            ("Capital", "EOY", 2.0, 100.0, 2e7, 9.0),
            ("Expense", "YTD", 3.0, 100.0, 0.0, 7.0)]     # single actual -> actual
    df = spark.createDataFrame(rows, "category string, period string, actual double, budget double, "
                                     "variance double, forecast double")
    got = {r.category: (r.actual, r.color) for r in finance.variance_colors(df, ["category", "period"]).collect()}
    # 9 / 100 >= .02 with variance >= 10M -> red; 3 / 100 >= .02 with a small variance -> amber.
    assert got == {"Capital": (9.0, "#FF0000"), "Expense": (3.0, "#FFA500")}


def test_rebaseline_resum(spark):
    from planscore.operators.targets import rebaselines
    from planscore.params import FIXTURE_RULES as R, ReportParams
    uf = spark.createDataFrame([("M Brand#1 A", "Wk 1 1998", 2.0), ("M Brand#1 B", "Wk 1 1998", 3.0)],
                               "nickname string, date_range string, rebaseline double")
    wt = spark.createDataFrame([("Brand#1",)], "program string")
    kept = sorted(r.rebaseline for r in rebaselines(uf, wt, ReportParams(), R).collect())
    summed = [tuple(r) for r in rebaselines(uf, wt, ReportParams(), R, resum=True).collect()]
    assert kept == [2.0, 3.0] and summed == [("Brand#1", 5.0)]


def test_week_gate(spark):
    from planscore.operators.calendar import business_day_of_week_gate
    c = cal(spark, dt.date(1998, 12, 20), dt.date(1999, 1, 15))
    assert business_day_of_week_gate(c, dt.date(1999, 1, 4), 1).count() == 1    # Monday
    assert business_day_of_week_gate(c, dt.date(1999, 1, 5), 1).count() == 0
    assert business_day_of_week_gate(c, dt.date(1999, 1, 5), 2).count() == 1
    # 1999-01-01 (Fri) is in ISO week 53, whose earlier days fall in 1998: first within 1999.
    assert business_day_of_week_gate(c, dt.date(1999, 1, 1), 1).count() == 1
