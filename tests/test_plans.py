"""Plans: columns are pruned at the scan, filters reach it, and nothing is a cross product."""

from __future__ import annotations

import pytest

from starloom.plans import registry


def plan(spark, sf, name: str) -> str:
    return registry.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["monthly_revenue", "top_customers", "org_chart", "revenue_as_is", "fact_build", "customer_drift", "cdc_net_changes", "p3_found"])
def test_no_cross_products(spark, sf, name):
    said = plan(spark, sf, name)
    assert "CartesianProduct" not in said and "BroadcastNestedLoopJoin" not in said


def test_scans_read_what_is_used(spark, sf):
    said = plan(spark, sf, "monthly_orders")
    assert "ship_name" not in said and "freight" not in said and "notes" not in said
    said = plan(spark, sf, "cdc_net_changes")
    assert "PushedFilters: [IsNotNull(event_id), GreaterThan(event_id,1000), LessThanOrEqual(event_id,6000)]" in said and "props" not in said


def test_versions_are_combined_before_the_shuffle(spark, sf):
    said = plan(spark, sf, "tombstone_count")
    assert "partial_max" in said


def test_changes_are_read_over_the_whole_log(spark, sf):
    events = spark.read.parquet(f"{sf}/events*")
    last = {r["user_id"]: r["lsn"] for r in events.groupBy("user_id").agg({"event_id": "max"}).withColumnRenamed("max(event_id)", "lsn").collect()}
    assert last and {r["key"]: r["lsn"] for r in registry.QUERIES["cdc_net_changes_whole"](spark, sf).collect()} == last
    assert sum(r["changes"] for r in registry.QUERIES["cdc_split_by_op_whole"](spark, sf).collect()) == events.count()
