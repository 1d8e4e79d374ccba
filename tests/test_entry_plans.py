import pytest

import __spark_entry__ as entry
from lakemart.plans import catalog, catalog_tables
from tests.conftest import SF

HEAD = ["q_fact_telemetry", "q_fact_order", "q_fact_event", "q_dim_customer", "q_dim_location",
        "q_scd2", "q_as_of_join", "q_hourly_rollup", "q_milestone_pivot", "q_skew_join"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "vehicle_sk" in df.columns


def test_every_query_has_an_oracle():
    own = {*catalog.QUERIES, *catalog_tables.QUERIES}
    assert own <= set(entry.queries()) and own <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", HEAD)
def test_plans_have_no_cartesian_or_python(spark, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, (name, bad)
