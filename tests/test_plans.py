"""Plan properties that matter at scale, checked on every batch query:
no cross products, no Python UDF evaluation, narrow scans, and the specific
pushdowns / partial aggregates the operators rely on."""

import re

import pytest

from floe.plans import REGISTRY
from tests.conftest import SF001

BATCH = sorted(n for n in REGISTRY if not n.startswith("stream_"))
TABLE_WIDTH = {
    "events": 6, "documents": 5, "orders": 6, "lineitem": 11, "customer": 5, "pages": 3, "benchmark": 2,
}


def executed_plan(spark, name):
    df = REGISTRY[name].build(spark, SF001)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_products_or_python_udfs(spark, name):
    plan = executed_plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, (name, bad)


@pytest.mark.parametrize("name", BATCH)
def test_scans_read_only_needed_columns(spark, name):
    plan = executed_plan(spark, name)
    for table, schema in re.findall(r"InMemoryFileIndex\(1 paths\)\[file:[^\]]*/(\w+)\.parquet\].*?ReadSchema: struct<([^>]*)>", plan):
        width = len(schema.split(","))
        # lineitem/events/orders queries never need every column
        assert width < TABLE_WIDTH.get(table, width + 1) or table in ("customer", "benchmark"), (name, table, schema)


def test_view_filter_reaches_the_scan(spark):
    plan = executed_plan(spark, "sliding_count")
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)" in plan


@pytest.mark.parametrize("name", ["word_count", "month_profit", "gd_lineitem", "sliding_count", "uri_count"])
def test_partial_aggregation_before_exchange(spark, name):
    plan = executed_plan(spark, name)
    assert re.search(r"(Hash|Sort|ObjectHash)Aggregate\(keys=.*functions=\[partial_", plan), name
