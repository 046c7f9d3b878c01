"""Every registered query against its SQL twin, and the plans of the central ones."""

import pytest
from compare import connect, differences

from __spark_entry__ import entry, queries
from ledgerline import registry
from ledgerline.plans import kpis
from oracles import ORACLES


@pytest.fixture(scope="module")
def duck(tables):
    return connect(tables)


def test_every_query_has_a_twin():
    assert set(registry.QUERIES) == set(ORACLES)
    assert set(registry.QUERIES) <= set(queries())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_its_sql(spark, tables, duck, name):
    """Same rows as the SQL; and neither pairs of everything nor Python in the plan."""
    df = queries()[name](spark, tables)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert word not in plan
    assert differences(df.collect(), df.columns, duck, ORACLES[name]) == ""


def test_entry(spark):
    assert entry(spark).columns[:3] == ["batch_id", "region", "plan_name"]


def plan_of(spark, tables, name):
    return queries()[name](spark, tables)._jdf.queryExecution().executedPlan().toString()


def test_status_filter_and_columns_reach_the_scan(spark, tables):
    plan = plan_of(spark, tables, "batch_mrr")
    assert "EqualNullSafe(o_orderstatus,O)" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan


def test_stored_indicators_read_one_batch_of_the_mart(spark, tables):
    mart = registry._stored_marts(spark, tables).load("mart", "mart_mrr")
    plan = kpis.total_mrr(mart, 3, "ASIA")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan and "EqualTo(region,ASIA)" in plan
    assert "o_orderdate" not in plan


def test_support_mart_does_not_expand_its_rows(spark, tables):
    assert "Expand" not in plan_of(spark, tables, "mart_support")
