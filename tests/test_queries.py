"""Every registered query against its SQL, and the shape of its plan."""

import pytest

import __spark_entry__ as contract
from brisa.plans.registry import ORACLES, QUERIES
from tests.parity import compare, duck

# At the smallest scale these have nothing to find; the larger one is used.
LARGER = {
    "A11_min_sample_mean", "B11_inference_pairs", "B12_inference_score", "B12_inference_score_from_states", "B23_T7_minute_presence",
}


@pytest.fixture(scope="module")
def databases():
    return {sf: duck(f"/root/testdata/{sf}") for sf in ("sf0.001", "sf0.01")}


# The corpus queries, where their package is present, have tests of their own beside it.
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, databases, name):
    sf = "sf0.01" if name in LARGER else "sf0.001"
    df = contract.queries()[name](spark, f"/root/testdata/{sf}")
    assert compare(df, databases[sf], contract.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_python_and_no_nested_loops(spark, sf, name):
    df = contract.queries()[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, bad


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) <= set(contract.oracle_sql())
    assert set(QUERIES) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "aqi" in df.columns
