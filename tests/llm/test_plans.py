"""Plans of the training-data queries: native ones run no Python, none joins crosswise."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
NAMES = [n for n in E.queries() if n.startswith("op")]


def plan(spark, name):
    return E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["op2_line_dedup", "op3_fingerprints"])
def test_native_operators_run_no_python(spark, name):
    assert not re.search(r"Python|Pandas|MapInArrow|ArrowEval|ExternalRDD", plan(spark, name))


@pytest.mark.parametrize("name", ["op1_decontaminate", "op4_mix_sources", "op10_chat_formatting", "op11_hard_negatives",
                                  "op12_secret_scan", "op13_periodic_runs"])
def test_no_cross_joins(spark, name):
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan(spark, name))


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in NAMES) == list(range(1, 14))
