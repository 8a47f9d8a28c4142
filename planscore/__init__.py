"""planscore: plan-versus-actuals scorecards, business-day gates and labour / finance
KPIs expressed as Spark DataFrame plans."""

from planscore.params import FIXTURE_RULES, REFERENCE_RULES, ProgramRules, ReportParams

__all__ = ["ReportParams", "ProgramRules", "FIXTURE_RULES", "REFERENCE_RULES"]
