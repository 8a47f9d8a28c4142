"""Report parameters and the program rule tables.

Rules (cohorts, exemptions, overrides, nickname map, classification) are data, not code: every
operator takes a :class:`ProgramRules`. Two instances ship: ``REFERENCE_RULES`` with the program
names of the original report, and ``FIXTURE_RULES`` that plays the same roles on the TPC-H-style
test tables (programs are part brands there).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ReportParams:
    """Scorecard parameters.

    ``actuals_date`` is the cutoff for phase-out dates. When it is ``None`` the cutoff falls back
    to ``as_of`` ("today"), and to ``current_date()`` only when both are ``None``. Pass ``as_of``
    for reproducible runs.
    """

    week: int = 38
    actuals_date: dt.date | None = dt.date(1998, 9, 28)
    rag_min: float = 0.995
    rag_max: float = 1.25
    output: str = "PDC"
    year: int = 1998
    as_of: dt.date | None = None

    @classmethod
    def reference_defaults(cls) -> "ReportParams":
        """The original report's defaults: week 38, cutoff 2024-09-28, thresholds .995 / 1.25,
        tag 'PDC', year 2024."""
        return cls(week=38, actuals_date=dt.date(2024, 9, 28), rag_min=0.995, rag_max=1.25,
                   output="PDC", year=2024)

    @classmethod
    def procedure_defaults(cls) -> "ReportParams":
        """The values the stored procedures actually ran with: their parameters are declared as
        bare ``DECIMAL`` (scale 0) and ``VARCHAR`` (length 1), so .995 / 1.25 become 1 / 1 and
        'PDC' becomes 'P'. These reproduce the second golden report."""
        return cls(week=38, actuals_date=dt.date(2024, 9, 28), rag_min=1.0, rag_max=1.0,
                   output="P", year=2024)

    def cutoff(self) -> Column:
        if self.actuals_date is not None:
            return F.lit(self.actuals_date)
        if self.as_of is not None:
            return F.lit(self.as_of)
        return F.current_date()

    def today(self) -> Column:
        return F.lit(self.as_of) if self.as_of is not None else F.current_date()

    def lookahead_week(self) -> int:
        # No wrap at year end: week 50 looks at week 54, which has no rows.
        return self.week + 4


@dataclass(frozen=True)
class ProgramRules:
    untracked: str
    cancel_exempt: str
    reference_cohort: tuple[str, ...]
    execute_cohort: tuple[str, ...]
    maintenance: tuple[str, ...]
    excluded_sub_program: str
    external_nickname: str
    external_program: str
    fractional_program: str
    design_black: tuple[str, ...]
    dependency_black: tuple[str, ...]
    nickname_map: tuple[tuple[str, str], ...]
    maintenance_label: str
    projects_label: str
    maintenance_owner: str | None = None
    projects_owner: str | None = None
    cancel_marker: str = "CNCL"
    complete_status: str = "COMP"
    # e.g. "UTF8_LCASE_RTRIM": compare names case-insensitively, ignoring trailing blanks.
    collation: str | None = None


# Fixed values of the original report (program names as they appear in its source data).
# Owner names are deployment data and are left for the caller to supply.
REFERENCE_RULES = ProgramRules(
    untracked="NOT IN PDC",
    cancel_exempt="ED WFM Surge Arresters HFTD",
    reference_cohort=("ED Pole Repl", "ED Pole Repl - Emergent", "Maintenance Capital",
                      "Maintenance Expense", "COE Capital", "COE Expense"),
    execute_cohort=("ED Pole Repl", "ED Pole Repl - Emergent", "Maintenance Capital",
                    "Maintenance Capital - Emergent", "Maintenance Expense",
                    "Maintenance Expense - Emergent", "COE Capital", "COE Expense"),
    maintenance=("Maintenance Capital", "Maintenance Expense", "COE Capital", "COE Expense"),
    excluded_sub_program="ED WFM Dist Fault Anticipation",
    external_nickname="ED WFM Dist Fault Anticipation",
    external_program="ED WFM Line Sensors",
    fractional_program="ED OH Conductor Repl Non-HFTD",
    design_black=("ED WFM Non-Exempt Expulsion Fuses HFTD", "ED WFM Line Sensors",
                  "Mobile Home Park Electric", "ED WFM Surge Arresters", "COE Expense",
                  "Maintenance Expense"),
    dependency_black=("Mobile Home Park Electric",),
    nickname_map=(("ED COE Capital", "COE Capital"),
                  ("ED COE Expense", "COE Expense"),
                  ("ED Maint EC Tags Expense", "Maintenance Expense"),
                  ("ED Maint Non-EC Tags Expense", "Maintenance Expense"),
                  ("ED Maint EC Tags Capital", "Maintenance Capital"),
                  ("ED Maint Non-EC Tags Capital", "Maintenance Capital")),
    maintenance_label="ED Maintenance",
    projects_label="ED Projects",
)

# The same roles on the test tables (see FIXTURES.md §4). "Brand#50" plays the design-override
# name that matches no program.
FIXTURE_RULES = ProgramRules(
    untracked="UNTRACKED",
    cancel_exempt="Brand#5",
    reference_cohort=("Brand#1", "Brand#2", "Brand#3"),
    execute_cohort=("Brand#1", "Brand#2", "Brand#3", "Brand#6"),
    maintenance=("Brand#2", "Brand#3"),
    excluded_sub_program="PROMO",
    external_nickname="Brand#4 PROMO",
    external_program="Brand#4",
    fractional_program="Brand#9",
    design_black=("Brand#11", "Brand#4", "Brand#12", "Brand#50", "Brand#3", "Brand#2"),
    dependency_black=("Brand#12",),
    nickname_map=(("M Brand#1 A", "Brand#1"),
                  ("M Brand#1 B", "Brand#1"),
                  ("C Brand#2", "Brand#2")),
    maintenance_label="Maintenance",
    projects_label="Projects",
    maintenance_owner="Owner M",
    projects_owner="Owner P",
)


def param_echo(spark, params: ReportParams):
    """The parameters as one row (week, cutoff, rag min, rag max), as the procedure's first
    result set. Reads no table, so it is a helper, not a registered query."""
    return spark.range(1).select(
        F.lit(params.week).alias("week"), params.cutoff().alias("actuals_date"),
        F.lit(float(params.rag_min)).alias("rag_min"), F.lit(float(params.rag_max)).alias("rag_max"))
