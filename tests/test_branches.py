"""Every branch of the measure and label rules occurs in the registered queries' results (read
from their oracles, which the oracle test ties to Spark)."""

import pytest

from oracle.compare import duck
from oracle.queries import ORACLE

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def rows(con, key, cols="*"):
    return con.execute(f"SELECT {cols} FROM ({ORACLE[key]}) x").fetchall()


def test_rag_threshold_below_inside_and_above_the_band(con):
    got = rows(con, "rag_threshold", "rag, round(actual / nullif(plan_raw, 0), 2)")
    ratios = [(rag, r) for rag, r in got if r is not None]
    assert any(rag == "RED" and r < 0.995 for rag, r in ratios)
    assert any(rag == "RED" and r > 1.25 for rag, r in ratios)
    assert any(rag == "GREEN" and 0.995 <= r <= 1.25 for rag, r in ratios)
    assert {rag for rag, in rows(con, "rag_black_override", "rag")} == {"RED", "GREEN", "BLACK"}


@pytest.mark.parametrize("a, b", [("scorecard_v1", "scorecard_v1_unit_thresholds"),
                                  ("scorecard_v4", "scorecard_v5"),
                                  ("pct_to_plan_v2", "pct_to_plan_v4"),
                                  ("pct_to_plan_v1", "pct_to_plan_v2"),
                                  ("scorecard_v2", "scorecard_v3")])
def test_variants_differ(con, a, b):
    assert sorted(map(str, rows(con, a))) != sorted(map(str, rows(con, b)))


def test_selected_values_single_blank_and_several(con):
    got = rows(con, "selected_value_cells", "budget, variance, actual")
    assert any(v is not None for _, v, _ in got) and any(v is None for _, v, _ in got)
    assert all(a is None for _, _, a in got)      # several values
    assert not any(b == 0 for b, _, _ in got)     # one value plus blanks is blank
    assert any(a in (1.2e7, 6e6) for a, in rows(con, "variance_color_forecast", "actual"))


def test_colours_periods_labels_and_gates(con):
    assert len({c for c, in rows(con, "variance_color", "color")}) == 3
    assert {p for p, in rows(con, "period_bucket_calendar", "period")} == {
        "This Month", "Actuals", "Future"}
    labels = {x for x, in rows(con, "month_label_calendar", "current_month_label")}
    assert None in labels and "" in labels and any(x and x.endswith("%") for x in labels)
    gates = rows(con, "gate_exists_counts", "n_rows, n_open, n_closed")
    assert gates and all(n == o > 0 and c == 0 for n, o, c in gates)
