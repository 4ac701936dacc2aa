"""Plan-shape guards: pushdown, map-side limits, no pair-producing joins."""

import os

import pytest

from sheetlake.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="generated tables not present")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_pushes_period_and_prunes(spark):
    df = QUERIES["customer_spending"](spark, SF)
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    lineitem_schema = [ln for ln in text.splitlines() if ln.startswith("ReadSchema: struct<l_")]
    assert lineitem_schema and all("l_comment" not in ln and "l_tax" not in ln for ln in lineitem_schema)
    assert "WindowGroupLimit" in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pair_producing_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_current_bills_reads_its_lines_once(spark):
    plan = plan_of(QUERIES["current_bills"](spark, SF))
    lines = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "l_shipdate" in ln]
    # the second branch holds NULL bills only: its scans filter on a NULL join key, or are gone
    assert sum("IsNull(l_orderkey)" not in ln for ln in lines) == 1
    assert plan.count("WindowGroupLimit") == 2
