import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as E  # noqa: E402
from riskframe.plans import catalog  # noqa: E402

SF = "/root/testdata/sf0.001"
SLOW = {"t5_logistic", "t6_random_forest", "t7_boosted_deep", "t8_boosted_shallow", "t9_mlp",
        "t10_evaluate_trained"}


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    n = spark.read.parquet(SF + "/lineitem.parquet").count()
    assert len(rows) == 5 and sum(r["n"] for r in rows) == n


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString() + \
        df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - SLOW))
def test_plans_have_no_python_or_cartesian(spark, name):
    df = E.queries()[name](spark, SF)
    plan = _plan(df)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


def test_scan_is_pruned(spark):
    df = E.queries()["p1_encode_flags"](spark, SF)
    scan = [line for line in df._jdf.queryExecution().executedPlan().toString().split("\n")
            if "FileScan parquet" in line][0]
    assert "l_extendedprice" not in scan and "l_returnflag" in scan
