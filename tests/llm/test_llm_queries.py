"""Registered queries: SQL oracles, and the rows-only ones run over the whole tables."""

import pytest

from oracle.compare import compare, duck
from planscore.llm.queries import LLM_ORACLE, LLM_QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_matches_oracle(spark, name):
    ok, msg = compare(LLM_QUERIES[name](spark, SF), duck(SF), LLM_ORACLE[name])
    assert ok, msg


def test_one_query_per_operator_and_the_pipeline():
    numbers = sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES if n != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in LLM_QUERIES


def test_native_queries_run_no_python(spark):
    for name, query in LLM_QUERIES.items():
        if name.split("_")[0] in ("op3", "op5", "op6", "op10"):
            plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
            assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan
