import os

import pytest

import __spark_entry__ as contract
from touchline.checks.compare import difference, duck

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
#: The league's queries; the optional training-data queries have tests of their own.
QUERIES = {k: v for k, v in contract.queries().items() if k not in contract.LLM_QUERIES}
ORACLES = {k: v for k, v in contract.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_oracle(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_stay_distributed(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "PythonUDF", "ArrowEval", "BatchEvalPython"):
        assert unwanted not in text


@pytest.mark.parametrize("name", ["fct_player_form", "latest_per_key", "next_fixture_per_team", "fct_captain_picks"])
def test_rows_are_cut_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    final, partial = text.find("Final"), text.find("Partial")
    assert "WindowGroupLimit" in text and final < text.find("Exchange", final) < partial


def test_top_k_needs_no_sort(spark):
    for name in ("top_k", "fct_captain_picks"):
        assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF_DIR))


def test_scans_read_only_what_they_need(spark):
    text = plan(QUERIES["conditional_count"](spark, SF_DIR))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text
    assert text.count("FileScan") == 2
