"""Queries that hold every row in state until the watermark moves keep it on disk, whatever store the
session has, and leave the session's settings as they were."""

import glob
import os
from datetime import datetime

import pytest

from orderflow.plans.flow import EventFlow
from orderflow.plans.stream_queries import ON_DISK, REGISTRY, state_partitions
from orderflow.session import checkpoint_root

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
HEAP = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


@pytest.fixture()
def heap_session(spark):
    old = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, HEAP)
    yield spark
    spark.conf.set(PROVIDER, old)


def _orders(spark, folder):
    rows = [(k, 7, 100.5 + k, datetime(2026, 1, 1 + k % 3)) for k in range(1, 61)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz") \
        .coalesce(1).write.parquet(f"{folder}/orders.parquet")
    return folder


def _scratch(spark):
    return set(glob.glob(f"{checkpoint_root(spark).removeprefix('file:')}/orderflow/stream-*"))


@pytest.mark.parametrize("name", ["stream_history", "stream_unique_events", "stream_business_facts"])
def test_state_is_kept_on_disk(heap_session, tmp_root, name):
    before = _scratch(heap_session)
    assert REGISTRY[name](heap_session, _orders(heap_session, tmp_root)).count() > 40
    (root,) = _scratch(heap_session) - before
    kinds = {os.path.splitext(f)[1] for f in glob.glob(f"{root}/**/state/[0-9]*/[0-9]*/**", recursive=True)}
    assert ".zip" in kinds and ".delta" not in kinds, kinds
    assert heap_session.conf.get(PROVIDER) == HEAP


def test_settings_are_put_back(heap_session):
    names = ["spark.sql.shuffle.partitions", *ON_DISK]
    old = {name: heap_session.conf.get(name, None) for name in names}
    with pytest.raises(KeyError), state_partitions(heap_session, on_disk=True):
        assert {name: heap_session.conf.get(name) for name in ON_DISK} == ON_DISK
        raise KeyError
    assert {name: heap_session.conf.get(name, None) for name in names} == old


def test_logs_of_the_dedup_query_are_packed(spark, tmp_root):
    before = _scratch(spark)
    REGISTRY["stream_unique_events"](spark, _orders(spark, tmp_root))
    (root,) = _scratch(spark) - before
    for log in ("valid", "unique"):
        files = glob.glob(f"{root}/{log}/*.parquet")
        assert files and all(f.endswith(".zstd.parquet") for f in files), files


def test_valid_events_are_parsed_once(spark, tmp_root):
    unique = EventFlow(spark, _orders(spark, tmp_root)).unique
    assert unique.count() > 100
    plan = unique._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1, plan
