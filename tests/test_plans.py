"""Plan-shape checks: the scale properties the design relies on, read from the physical plans."""

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as E
from planscore.operators.actuals import NOTIFICATION_KEYS, notification_actuals
from planscore.params import FIXTURE_RULES as R
from planscore.params import ReportParams
from planscore.plans.scorecard import scorecard
from planscore.registry import inputs, tables
from planscore.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_program_rollup_pre_aggregates_before_shuffle(spark):
    plan = physical(E.queries()["program_actuals"](spark, SF))
    # Spark spells the map-side step partial_sum; it must sit below the program exchange.
    assert "partial_sum" in plan
    assert plan.index("Exchange hashpartitioning(program") < plan.rindex("partial_sum")


def test_scorecard_scans_work_items_once(spark):
    df = scorecard(inputs(spark, SF), ReportParams(), R, "v4")
    plan = physical(df)
    # Only the work-item view reads l_returnflag: one such scan means actuals are computed once.
    scans = [ln for ln in plan.splitlines()
             if "ReadSchema" in ln and "l_returnflag" in ln.split("ReadSchema")[1]]
    assert len(scans) == 1


@pytest.mark.parametrize("key", ["scorecard_v1", "scorecard_v6", "notification_actuals",
                                 "rebaseline_semi", "variance_color", "labour_kpi",
                                 "nth_business_day_month", "source_weekly_targets",
                                 "cohort_semi", "cohort_anti"])
def test_no_products(spark, key):
    plan = physical(E.queries()[key](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_year_range_reaches_orders_scan(spark):
    plan = physical(E.queries()["source_weekly_targets"](spark, SF))
    scans = [ln for ln in plan.splitlines() if "o_orderdate" in ln and "PushedFilters" in ln]
    assert any("GreaterThanOrEqual(o_orderdate" in ln and "LessThan(o_orderdate" in ln
               for ln in scans)


def test_scans_read_only_needed_columns(spark):
    plan = physical(E.queries()["program_actuals"](spark, SF))
    li = [ln for ln in plan.splitlines() if "lineitem" in ln and "ReadSchema" in ln][0]
    assert "l_extendedprice" not in li and "l_discount" not in li and "l_tax" not in li


def test_closed_gate_reads_nothing(spark):
    plan = physical(E.queries()["gated_report"](spark, SF))
    assert "FileScan" not in plan and "Scan parquet" not in plan


def test_lazy_gate_is_a_subquery_not_a_join(spark):
    from planscore.plans.gate import gated_scorecard
    from planscore.registry import P_V6_ON, _cal
    df = gated_scorecard(inputs(spark, SF), _cal(spark, SF), P_V6_ON, R, decide_first=False)
    plan = physical(df)
    assert "Subquery" in plan and "BroadcastNestedLoopJoin" not in plan


def test_nth_business_day_uses_window_group_limit(spark):
    plan = physical(E.queries()["nth_business_day_month"](spark, SF))
    assert "WindowGroupLimit" in plan


def lineitem_scans(plan: str) -> int:
    return len([x for x in plan.splitlines() if "ReadSchema" in x and "/lineitem.parquet" in x])


def test_each_input_of_the_scorecard_is_read_once(spark):
    """Work items, targets (week, look-ahead week and program list together) and forecasts."""
    assert lineitem_scans(physical(E.queries()["scorecard_v4"](spark, SF))) == 3
    assert lineitem_scans(physical(E.queries()["scorecard_v4_union_form"](spark, SF))) > 3


def sort_merge_session(spark):
    """Sort-merge joins, as at scale."""
    s = spark.newSession()
    s.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    s.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    return s


def test_notification_grain_exchanges_partial_sums_by_all_keys(spark):
    plan = physical(E.queries()["notification_actuals"](sort_merge_session(spark), SF))
    lines = plan.splitlines()
    at = [i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x and "work_order" in x]
    assert len(at) == 1 and "reference_date" in lines[at[0]]
    assert "partial_sum" in lines[at[0] + 1]


def test_notification_grain_without_splitting_needs_no_shuffle_of_its_own(spark):
    s = sort_merge_session(spark)
    plan = physical(notification_actuals(fx.work_items(tables(s, SF)), ReportParams(), R,
                                         split_hot_keys=False))
    exchanges = [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln]
    assert exchanges and not any("program" in ln or "notification" in ln for ln in exchanges)


def hot_order_items(s, rows=40_000):
    """Work items joined to their orders; one order holds 30 % of the rows."""
    items = s.range(rows).select(
        F.when(F.col("id") % 10 < 3, F.lit(7)).otherwise(F.col("id")).alias("k"), "id")
    orders = s.range(rows).select(F.col("id").alias("notification"), F.lit("R").alias("region"))
    day = F.lit("1998-03-01").cast("date")
    dates = [day.alias(c) for c in NOTIFICATION_KEYS
             if c.endswith("_out") or c.endswith("_date") and c != "click_end_date"]
    done = {"program", "notification", "work_order", "region", "reporting_year", "user_status",
            "click_end_date", *[c for c in NOTIFICATION_KEYS
                                if c.endswith("_out") or c.endswith("_date")]}
    return items.join(orders, F.col("k") == F.col("notification")).select(
        F.lit("Brand#10").alias("program"), F.lit("S").alias("sub_program"), "notification",
        F.col("id").cast("int").alias("work_order"), "region", F.lit(1998).alias("reporting_year"),
        F.lit("WIP").alias("user_status"), day.cast("timestamp_ntz").alias("click_end_date"), *dates,
        *[F.lit("x").alias(c) for c in NOTIFICATION_KEYS if c not in done],
        *[F.lit(1.0).alias(c) for c in ("initiation_actuals", "design_actuals",
                                        "dependency_actuals", "schedule_actuals",
                                        "execute_actuals", "in_workplan")])


def test_a_hot_notification_is_split(spark):
    """One order with 30 % of the rows: AQE splits it in the join, and the sums of its work orders
    spread over all partitions. (Only the size from which a partition counts as large is lowered.)"""
    s = sort_merge_session(spark)
    for k, v in (("spark.sql.shuffle.partitions", "8"),
                 ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16kb"),
                 ("spark.sql.adaptive.coalescePartitions.enabled", "false"),
                 ("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "16kb"),
                 ("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")):
        s.conf.set(k, v)

    def final_plan(split):
        df = notification_actuals(hot_order_items(s), ReportParams(), R, split_hot_keys=split)
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        total = df.agg(F.count("*"), F.sum("in_workplan"))
        got = total.collect()[0]
        assert (got[0], got[1]) == (40_000, 40_000.0)
        return physical(total), sorted(sizes)
    plan, sizes = final_plan(True)
    assert "isSkew=true" in plan or "skew=true" in plan
    assert max(sizes) <= 3 * sizes[len(sizes) // 2]
    plan, sizes = final_plan(False)
    assert "skew=true" not in plan.lower().replace("isskew", "skew")
    assert max(sizes) > 2 * sizes[len(sizes) // 2]
