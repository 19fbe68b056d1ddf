"""Named queries that run the streaming stages over the given tables and read what they delivered.

The event log derived from ``orders`` is written as topic files and drained by the same runners a
deployment uses (``availableNow``); the result is read from the written logs and tables.  The oracles
are the batch queries' own: a drained stream without rows behind the watermark equals batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contract as C
from ..operators import states as st
from ..operators import validate as va
from ..session import scratch_path
from ..sources import topics as tp
from ..streaming import changes, jobs, pending, sinks
from . import history as hi
from .flow import EventFlow

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


#: State in RocksDB on the executors' disks, within one bound of memory an executor; rows are not
#: counted, which would look up each key again before it is put or removed.
ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"
ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{ROCKSDB}.boundedMemoryUsage": "true",
    f"{ROCKSDB}.trackTotalNumberOfRows": "false",
    f"{ROCKSDB}.compression": "zstd",
}


@contextmanager
def state_partitions(spark: SparkSession, on_disk: bool = False) -> Iterator[None]:
    """A stateful query keeps the partition count of its first run: here one for each core there is.

    ``on_disk``: its state is kept on disk.  A log drained in one micro-batch puts every row into the
    state before the watermark moves, and the default store keeps all of it in the executors' heaps.
    """
    values = {"spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism), **(ON_DISK if on_disk else {})}
    old = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _written(df: DataFrame, path: str) -> str:
    df.write.option("compression", "zstd").parquet(path)
    return path


def _topic_files(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    return tp.file_topics(spark, _written(EventFlow(spark, sf_dir).topic_rows, f"{root}/topics"))


def _unique_records(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """The unique events as forwarded ``(key, value)`` records, as a stream."""
    unique = EventFlow(spark, sf_dir).unique
    value = F.to_json(F.struct("event_id", "event_type", "order_id", "customer_id", "payload", F.date_format(
        "event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("event_time")))
    return tp.key_value_files(spark, _written(unique.select(F.col("kafka_key").alias("key"), value.alias("value")),
                                              f"{root}/unique"))


@query
def stream_history(spark, sf_dir):
    """All four stages (S1, S2, K1, K2, D1, J1, J2, K4, W9): the history table they deliver."""
    root = scratch_path(spark, "stream-history")
    with state_partitions(spark, on_disk=True):
        paths = jobs.run_pipeline(spark, _topic_files(spark, sf_dir, root), f"{root}/run")
    return hi.read(spark, paths.history).select(*st.HISTORY_COLUMNS)


@query
def stream_routes(spark, sf_dir):
    """Records of stage 1's log by route and error code (K2)."""
    root = scratch_path(spark, "stream-routes")
    jobs.run_to_end(jobs.run_validation(_topic_files(spark, sf_dir, root), f"{root}/routed", f"{root}/ck"))
    log = spark.read.schema("key string, value string, route string").parquet(f"{root}/routed")
    code = F.when(F.col("route") == C.INVALID, F.get_json_object("value", "$.error_reason"))
    return log.groupBy("route", code.alias("error_reason")).agg(F.count(F.lit(1)).alias("record_count"))


@query
def stream_unique_events(spark, sf_dir):
    """Event ids that the watermarked two-level dedup forwards."""
    root = scratch_path(spark, "stream-unique")
    valid = va.valid_records(EventFlow(spark, sf_dir).classified)
    records = tp.key_value_files(spark, _written(valid, f"{root}/valid"))
    with state_partitions(spark, on_disk=True):
        jobs.run_to_end(jobs.run_dedup(records, f"{root}/unique", f"{root}/ck", spread=8))
    return tp.key_value_log(spark, f"{root}/unique", streaming=False).select(
        "key", F.get_json_object("value", "$.event_id").alias("event_id"))


@query
def stream_current_state(spark, sf_dir):
    """The current-state table kept by the stream of state records."""
    root = scratch_path(spark, "stream-current")
    states = st.order_status(EventFlow(spark, sf_dir).correlated(), with_decision=True)
    records = tp.key_value_files(spark, _written(st.state_record(states), f"{root}/states"))
    jobs.run_to_end(jobs.run_current(records, f"{root}/current", f"{root}/ck"))
    return sinks.read_current(spark, f"{root}/current")


@query
def stream_order_completion(spark, sf_dir):
    """Completion rate by order, from deltas that take back an order's earlier state (M4)."""
    root = scratch_path(spark, "stream-changes")
    states = st.order_status(EventFlow(spark, sf_dir).correlated(), with_decision=True)
    records = tp.key_value_files(spark, _written(st.state_record(states), f"{root}/states"))
    with state_partitions(spark):
        jobs.run_to_end(changes.run_order_changes(records, f"{root}/changes", f"{root}/ck"))
    return changes.completion_by_order(spark, f"{root}/changes")


@query
def stream_expired_orders(spark, sf_dir):
    """Orders whose wait is over, by event-time timers."""
    root = scratch_path(spark, "stream-expired")
    with state_partitions(spark):
        jobs.run_to_end(pending.run_pending(_unique_records(spark, sf_dir, root), f"{root}/expired", f"{root}/ck"))
    return spark.read.schema(pending.EXPIRED).parquet(f"{root}/expired")


@query
def stream_business_facts(spark, sf_dir):
    """Business keys that the streaming business dedup forwards."""
    root = scratch_path(spark, "stream-facts")
    records = _unique_records(spark, sf_dir, root)  # a batch job, with the session's partitions
    with state_partitions(spark, on_disk=True):
        jobs.run_to_end(jobs.run_business_dedup(records, f"{root}/facts", f"{root}/ck"))
    facts = tp.key_value_log(spark, f"{root}/facts", streaming=False)
    event = va.parse_envelope(F.col("value"), permissive=False).alias("e")
    return facts.select(event).select("e.order_id", "e.event_type", "e.payload.payment_id", "e.payload.sku")


@query
def stream_metric_rows(spark, sf_dir):
    """Durable metric rows of the four running metrics."""
    root = scratch_path(spark, "stream-metrics")
    records = _unique_records(spark, sf_dir, root)
    states = st.state_record(EventFlow(spark, sf_dir).states)
    state_records = tp.key_value_files(spark, _written(states, f"{root}/states"))
    with state_partitions(spark):
        for run, source in ((jobs.run_volume, records), (jobs.run_orders_per_minute, records),
                            (jobs.run_failure_rate, records), (jobs.run_completion, state_records)):
            jobs.run_to_end(run(source, f"{root}/metrics", f"{root}/ck-{run.__name__}"))
    return sinks.read_metrics(spark, f"{root}/metrics").select("metric_name", "window_start", "window_end", "metric_value")
