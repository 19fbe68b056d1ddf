"""Plan-shape regression tests: the physical plans a large input gets (no AQE re-planning,
no size-based broadcast) keep their scale properties."""

import os
import sys

import pytest

from orderflow.plans.queries import REGISTRY, queries

from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from plan_report import summarise  # noqa: E402

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


@pytest.fixture()
def static_plans(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled",
                                          "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def plan(name):
        df = queries()[name](spark, SF_SMALL)
        tree = df._jdf.queryExecution().executedPlan().toString()
        formatted = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        return summarise(tree, formatted), tree

    yield plan
    for k, v in old.items():
        spark.conf.set(k, v)


def test_no_cross_products_or_row_python(static_plans):
    for name in REGISTRY:  # the streaming queries read written tables
        s, _ = static_plans(name)
        assert not any(op in s["ops"] for op in FORBIDDEN), name


def test_correlation_shuffles(static_plans):
    s, _ = static_plans("correlated")
    assert s["ops"].get("SortMergeJoin") == 2
    # dedup by event_id, order side of J1, payment side, inventory side; J1's output enters J2
    # without a shuffle
    assert len(s["exchanges"]) == 4, s["exchanges"]
    assert sum("_ob" in e for e in s["exchanges"]) == 1


def test_scan_reads_only_needed_columns(static_plans):
    s, _ = static_plans("validation_counts")
    assert s["schemas"] == ["struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,"
                            "o_orderdate:timestamp_ntz>"]


def test_dedup_combines_before_shuffle(static_plans):
    _, tree = static_plans("deduplicated_events")
    exchange_at = tree.index("Exchange hashpartitioning(event_id")
    assert "partial_min" in tree[exchange_at:], "no map-side combine below the dedup shuffle"


def test_events_by_order_stays_in_the_jvm(static_plans):
    s, tree = static_plans("events_by_order")
    assert "Window" in s["ops"] and "MapInPandas" not in tree and "RDD" not in tree
    assert not any(op in s["ops"] for op in FORBIDDEN)


def test_audit_reads_and_shuffles_the_log_once(static_plans):
    s, tree = static_plans("audit_event_log")
    assert tree.count("FileScan parquet") == 1
    assert sum("hashpartitioning" in e for e in s["exchanges"]) == 1, s["exchanges"]


def test_history_table_correlates_once(static_plans):
    s, tree = static_plans("history_table")
    assert s["ops"].get("SortMergeJoin") == 2 and "Union" not in s["ops"], s["ops"]
