"""The job entry point writes the report; a closed v6 gate writes nothing."""

from planscore.run_report import parse_args, run

SF = "/root/testdata/sf0.001"


def test_report_job_writes_tsv(spark, tmp_path):
    out = str(tmp_path / "rep")
    args = parse_args(["--fixture-dir", SF, "--rules", "fixture", "--year", "1998",
                       "--actuals-date", "1998-09-28", "--version", "v1", "--out", out])
    assert run(spark, args) == out
    lines = "".join(p.read_text() for p in sorted((tmp_path / "rep").glob("part-*"))).splitlines()
    assert lines[0].startswith("Output\tMega Process\tMPO")
    assert len(lines) == 226
    programs = [ln.split("\t")[4] for ln in lines[1:]]
    assert programs == sorted(programs)


def test_v6_gate(spark, tmp_path):
    base = ["--fixture-dir", SF, "--rules", "fixture", "--year", "1998", "--version", "v6"]
    assert run(spark, parse_args(base + ["--as-of", "1998-09-08", "--out", str(tmp_path / "a")])) is None
    assert run(spark, parse_args(base + ["--as-of", "1998-09-07", "--out", str(tmp_path / "b")]))


def test_report_job_on_stored_inputs(spark, tmp_path):
    from collections import Counter

    from planscore.params import FIXTURE_RULES as R
    from planscore.params import ReportParams
    from planscore.plans.scorecard import scorecard
    from planscore.registry import inputs, tables
    from planscore.sources.fixtures import write_inputs
    from planscore.sources.sinks import read_report_tsv

    paths = write_inputs(tables(spark, SF), str(tmp_path / "inputs"))
    stored = ["--work-items", paths["work_items"], "--weekly-targets", paths["weekly_targets"],
              "--unit-forecast", paths["unit_forecast"], "--calendar", paths["calendar"],
              "--rules", "fixture", "--year", "1998"]
    out = run(spark, parse_args(stored + ["--version", "v4", "--actuals-date", "1998-09-28",
                                          "--out", str(tmp_path / "v4")]))
    got = Counter(map(tuple, read_report_tsv(spark, out).collect()))
    want = Counter(map(tuple, scorecard(inputs(spark, SF), ReportParams(), R, "v4").collect()))
    assert got == want
    assert run(spark, parse_args(stored + ["--version", "v6", "--as-of", "1998-09-07",
                                           "--out", str(tmp_path / "v6")]))


def test_report_views_for_sql(spark):
    from planscore.params import FIXTURE_RULES as R
    from planscore.params import ReportParams
    from planscore.plans.views import register_report_views
    from planscore.registry import inputs

    names = register_report_views(spark, inputs(spark, SF), ReportParams(), R, prefix="t_")
    assert "t_scorecard_v4" in names and "t_program_actuals" in names
    n = spark.sql("SELECT count(*) AS n FROM t_scorecard_v4").collect()[0].n
    assert n == 225
    joined = spark.sql("""SELECT s.program, s.completions, a.initiation_actuals
                          FROM t_scorecard_v1 s JOIN t_program_actuals a USING (program)
                          WHERE s.phase = 'Initiation'""").collect()
    assert joined and all(r.completions == (r.initiation_actuals or 0.0) for r in joined)
