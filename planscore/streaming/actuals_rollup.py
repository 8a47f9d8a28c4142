"""Program-day rollup of work-item actuals, maintained incrementally.

The report is run daily and re-reads the whole work-item history each time. Everything it needs
from that history, for any cutoff date, is held in a rollup keyed by
(program, measure, out_date, always): the sum of the gated values, their non-NULL count and the
row count. The state is bounded by programs x 6 measures x days, independent of the number of
work items, so a Structured Streaming aggregation can keep it current as new work items land,
and the daily report reads a few thousand rows instead of the history.

* initiation / design / dependency / execute: bucketed by their phase-out date; a cutoff keeps
  the buckets with ``out_date <= cutoff`` (no ELSE, so NULL when nothing qualifies).
* schedule: rows counted regardless of the cutoff (done in the year, or completed by reference
  date for the cohort, or outside the reporting year with value 0) go to ``always`` buckets; the
  others are bucketed by CLICK end date and count when it is within eight weeks of the cutoff.
  A non-qualifying row still contributes 0, which the counts preserve.
* in_workplan: always counted.

Year gates and cohort rules are fixed per rollup (report year, rules); the cutoff is chosen at
read time by :func:`program_actuals_from_rollup`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from planscore.operators.actuals import ACTUAL_COLUMNS, classify, execute_gated, year_gated
from planscore.operators.filters import in_year, reference_complete, report_scope
from planscore.params import ProgramRules, ReportParams

ROLLUP_KEYS = ("program", "measure", "out_date", "always")


def _entries(params: ReportParams, rules: ProgramRules) -> Column:
    this_year = F.coalesce(F.col("reporting_year") == params.year, F.lit(False))
    cohort = F.col("program").isin(*rules.reference_cohort)
    done = F.when(cohort, reference_complete(params, rules)).otherwise(
        in_year("report_date", params.year))
    sched_always = ~this_year | F.coalesce(done, F.lit(False))
    sched_value = F.when(this_year, F.col("schedule_actuals")).otherwise(F.lit(0.0))
    no_date = F.lit(None).cast("date")

    def entry(measure, out_date, always, value):
        return F.struct(F.lit(measure).alias("measure"), out_date.alias("out_date"),
                        always.alias("always"), value.alias("value"))

    return F.array(
        entry("initiation", F.col("initiation_out"), F.lit(False),
              year_gated("initiation_actuals", params)),
        entry("design", F.col("design_out"), F.lit(False), year_gated("design_actuals", params)),
        entry("dependency", F.col("dependency_out"), F.lit(False),
              year_gated("dependency_actuals", params)),
        entry("execute", F.col("execute_out"), F.lit(False), execute_gated(params, rules)),
        entry("schedule", F.when(sched_always, no_date).otherwise(
            F.col("click_end_date").cast("date")),
              sched_always, sched_value),
        entry("in_workplan", no_date, F.lit(True), year_gated("in_workplan", params)),
    )


def actuals_rollup(wi: DataFrame, params: ReportParams, rules: ProgramRules) -> DataFrame:
    """The rollup from work items (batch or streaming DataFrame)."""
    long = (wi.filter(report_scope(params, rules))
            .select("program", F.inline(_entries(params, rules))))
    return long.groupBy(*ROLLUP_KEYS).agg(F.sum("value").alias("value"),
                                          F.count("value").alias("n_values"),
                                          F.count(F.lit(1)).alias("n_rows"))


def program_actuals_from_rollup(rollup: DataFrame, params: ReportParams,
                                rules: ProgramRules) -> DataFrame:
    """Same columns and values as :func:`planscore.operators.actuals.program_actuals`."""
    c = params.cutoff()
    m, d = F.col("measure"), F.col("out_date")

    def by_cutoff(measure):
        return F.sum(F.when((m == measure) & (d <= c), F.col("value")))

    sched_in = (m == "schedule") & (F.col("always") | (d <= F.date_add(c, 56)))
    sched_out = (m == "schedule") & ~F.col("always") & ~F.coalesce(d <= F.date_add(c, 56),
                                                                   F.lit(False))
    g = rollup.groupBy("program").agg(
        by_cutoff("initiation").alias("initiation_actuals"),
        by_cutoff("design").alias("design_actuals"),
        by_cutoff("dependency").alias("dependency_actuals"),
        F.sum(F.when(sched_in, F.col("value"))).alias("_sched"),
        (F.sum(F.when(sched_in, F.col("n_values")).otherwise(0))
         + F.sum(F.when(sched_out, F.col("n_rows")).otherwise(0))).alias("_sched_n"),
        by_cutoff("execute").alias("execute_actuals_without_external"),
        F.sum(F.when(m == "in_workplan", F.col("value"))).alias("total_in_workplan"),
    )
    g = g.withColumn("schedule_actuals",
                     F.when(F.col("_sched_n") > 0, F.coalesce("_sched", F.lit(0.0))))
    return g.select("program", *classify(rules), *ACTUAL_COLUMNS)


def start_rollup_stream(work_items_stream: DataFrame, params: ReportParams, rules: ProgramRules,
                        table_path: str, checkpoint_path: str,
                        available_now: bool = True) -> StreamingQuery:
    """Keep the rollup under ``table_path`` current.

    Complete output mode rewrites the whole (bounded) rollup each micro-batch into a folder of its
    own (``batch=<id>``). A folder counts once its ``_SUCCESS`` marker is there, so a reader
    (:func:`read_rollup`) or a crash in mid-batch always finds the last complete table; a replayed
    batch overwrites its own folder with the same rows, and older folders are dropped after the
    next one is complete. State and progress live under ``checkpoint_path`` (a shared folder).

    The aggregation state is sized by ``spark.sql.shuffle.partitions`` of the stream's session when
    the checkpoint is first written. It holds programs x 6 x days keys, so a few dozen partitions
    serve any data volume: start the stream from ``spark.newSession()`` with that setting."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table_path}/batch={batch_id}")
        for old in _batches(batch.sparkSession, table_path):
            if old < batch_id - 1:      # keep the one that a reader may just have opened
                _fs_path(batch.sparkSession, f"{table_path}/batch={old}", delete=True)

    writer = (actuals_rollup(work_items_stream, params, rules).writeStream
              .outputMode("complete").option("checkpointLocation", checkpoint_path)
              .foreachBatch(write))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 hour")
    return writer.start()


def _fs_path(spark, path: str, delete: bool = False):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if delete:
        fs.delete(p, True)
    return fs, p


def _batches(spark, table_path: str) -> list[int]:
    """Complete batches of the rollup table, ascending."""
    fs, p = _fs_path(spark, table_path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    ids = sorted(int(n.split("=")[1]) for n in names if n.startswith("batch="))
    return [i for i in ids if fs.exists(
        spark._jvm.org.apache.hadoop.fs.Path(f"{table_path}/batch={i}/_SUCCESS"))]


def read_rollup(spark, table_path: str) -> DataFrame:
    """The latest complete rollup."""
    done = _batches(spark, table_path)
    if not done:
        raise FileNotFoundError(f"no complete rollup under {table_path}")
    return spark.read.parquet(f"{table_path}/batch={done[-1]}")
