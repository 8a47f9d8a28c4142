"""Run the scorecard as a job and write the tab-separated report (the stored-procedure call,
re-aimed as a Spark application).

    spark-submit planscore/run_report.py --work-items P --weekly-targets P --unit-forecast P \\
        [--calendar P] --version v4 --week 38 --actuals-date 2024-09-28 --year 2024 \\
        --rules reference --owners "Owner M" "Owner P" [--out PATH]

``--fixture-dir`` builds the inputs from the TPC-H-style test tables instead. Without ``--out``
the report goes under the session's ``spark.checkpoint.dir``. For v6 the report is written only
when ``--as-of`` is the n-th business day of its month; otherwise nothing is written.
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt
import sys
import uuid

from pyspark.sql import SparkSession

from planscore.params import FIXTURE_RULES, REFERENCE_RULES, ReportParams
from planscore.plans.gate import run_gate
from planscore.plans.scorecard import VERSIONS, ScorecardInputs, scorecard
from planscore.session import checkpoint_dir, ensure_conf
from planscore.sources import fixtures as fx
from planscore.sources.sinks import write_report_tsv
from planscore.sources.tables import Tables


def _date(s: str | None) -> dt.date | None:
    return dt.date.fromisoformat(s) if s else None


def parse_args(argv: list[str]) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="planscore.run_report")
    src = ap.add_argument_group("inputs")
    src.add_argument("--fixture-dir", help="derive inputs from TPC-H-style tables in this dir")
    src.add_argument("--work-items")
    src.add_argument("--weekly-targets")
    src.add_argument("--unit-forecast")
    src.add_argument("--calendar", help="calendar table (needed for v6)")
    ap.add_argument("--version", choices=VERSIONS, default="v4")
    ap.add_argument("--week", type=int, default=38)
    ap.add_argument("--actuals-date", help="cutoff (default: --as-of, else today)")
    ap.add_argument("--as-of", help="run date (default today)")
    ap.add_argument("--year", type=int, default=2024)
    ap.add_argument("--rag-min", type=float, default=0.995)
    ap.add_argument("--rag-max", type=float, default=1.25)
    ap.add_argument("--output-tag", default="PDC")
    ap.add_argument("--business-day", type=int, default=5, help="v6 gate: n-th business day")
    ap.add_argument("--gate", choices=("month", "week"), default="month",
                    help="v6 gate: n-th business day of the month or of the week")
    ap.add_argument("--rules", choices=("reference", "fixture"), default="reference")
    ap.add_argument("--owners", nargs=2, metavar=("MAINTENANCE", "PROJECTS"))
    ap.add_argument("--collation", help='e.g. "UTF8_LCASE_RTRIM"')
    ap.add_argument("--out", help="output folder (default: under spark.checkpoint.dir)")
    return ap.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> str | None:
    ensure_conf(spark)
    rules = REFERENCE_RULES if args.rules == "reference" else FIXTURE_RULES
    if args.owners:
        rules = dataclasses.replace(rules, maintenance_owner=args.owners[0],
                                    projects_owner=args.owners[1])
    if args.collation:
        rules = dataclasses.replace(rules, collation=args.collation)
    params = ReportParams(week=args.week, actuals_date=_date(args.actuals_date),
                          rag_min=args.rag_min, rag_max=args.rag_max, output=args.output_tag,
                          year=args.year, as_of=_date(args.as_of))
    t = Tables.of(spark, args.fixture_dir) if args.fixture_dir else None
    if args.version == "v6":
        # Decide the gate first (calendar-sized), as the procedure does; closed -> no run.
        calendar = (fx.calendar(t) if t is not None
                    else spark.read.parquet(args.calendar) if args.calendar else None)
        if calendar is None:
            raise SystemExit("--calendar is required for v6")
        if params.as_of is None:
            params = dataclasses.replace(params, as_of=dt.date.today())
        if run_gate(calendar, params.as_of, args.business_day, args.gate).isEmpty():
            return None
    if t is not None:
        inputs = ScorecardInputs(fx.work_items(t), fx.weekly_targets(t, args.year),
                                 fx.unit_forecast(t, args.year))
    else:
        inputs = ScorecardInputs(spark.read.parquet(args.work_items),
                                 spark.read.parquet(args.weekly_targets),
                                 spark.read.parquet(args.unit_forecast))
    if args.version == "v6":
        report = scorecard(inputs, params, rules, "v4")
    else:
        if args.version == "v5" and params.as_of is None and params.actuals_date is None:
            params = dataclasses.replace(params, as_of=dt.date.today())
        report = scorecard(inputs, params, rules, args.version)
    out = args.out or (f"{checkpoint_dir(spark).rstrip('/')}/"
                       f"scorecard-{args.version}-{uuid.uuid4().hex}")
    return write_report_tsv(report, out, single_file=True)


def main(argv: list[str] | None = None) -> int:
    args = parse_args(sys.argv[1:] if argv is None else argv)
    spark = SparkSession.builder.appName("planscore-report").getOrCreate()
    path = run(spark, args)
    print(path if path else "gate closed: not the scheduled business day; no report written")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
