"""Micro-batch sinks (``foreachBatch`` callbacks) with replay-safe writes.

The forward logs of the pipeline (validated and dead letters, unique events, states) are written by
Spark's file sink, whose commit log lets readers see each committed file once; nothing here takes
part in that.  The keyed tables -- history, current state and metrics -- are written here: what a
micro-batch writes is named by the query's id (stable in its checkpoint) and the batch id, and
replaces what had that name.  A replay therefore replaces its own earlier output, and a query with a
new checkpoint, whose batch ids begin at 0 again, never touches what another query delivered.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import states as st
from ..plans import history as hi
from ..plans.keyed import FAN_IN

def replace_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Write ``df`` so that it replaces just the partitions it has rows of."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partitions).parquet(path))


def upsert_history(path: str, buckets: int = hi.BUCKETS, fan_in: int = FAN_IN) -> Callable[..., None]:
    """Store parsed states under their deterministic key ``(order_id, state_id)``.

    Distributed: the state id is a native column and the batch is written by the executors (no row
    loop on the driver) to a folder of its own, which a new version of the table names
    (``plans.keyed``).  A replayed batch replaces its own folder; equal keys collapse in
    ``read_history`` and where folders are merged, ``fan_in`` at a time.
    """
    table = hi.history(path, buckets)

    def run(batch: DataFrame, batch_id: int, query_id: str = "direct") -> None:
        table.append(st.history_rows(batch), f"{query_id}/{batch_id}")
        table.compact(batch.sparkSession, fan_in)

    return run


def upsert_current(path: str, buckets: int = hi.BUCKETS, fan_in: int = FAN_IN) -> Callable[..., None]:
    """Keep the latest state per order: each batch adds its own latest rows, reads and merges keep
    the one decided last, so late, repeated and replayed decisions leave the table right."""
    table = hi.current(path, buckets)

    def run(batch: DataFrame, batch_id: int, query_id: str = "direct") -> None:
        table.append(st.latest_state(st.history_rows(batch)), f"{query_id}/{batch_id}")
        table.compact(batch.sparkSession, fan_in)

    return run


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The current state of every order, as ``states.current_state`` gives it."""
    return hi.current(path).read(spark).drop(st.DECIDED)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The keyed history table: one row per ``(order_id, state_id)``."""
    return hi.read(spark, path)


def upsert_metrics(path: str, metric_name: str, value: str, by: Sequence[str] = ()) -> Callable[..., None]:
    """Durable metric rows from an update-mode aggregate: column ``value`` of each updated row.

    The key is (metric_name, window_start, window_end, *by); an aggregate without windows has NULL
    window bounds.  ``read_metrics`` keeps the latest value per key.
    """

    def run(batch: DataFrame, batch_id: int, query_id: str = "direct") -> None:
        window = [F.col(c) if c in batch.columns else F.lit(None).cast("timestamp").alias(c)
                  for c in ("window_start", "window_end")]
        rows = batch.select(
            F.lit(metric_name).alias("metric_name"), *window,
            F.to_json(F.struct(*[F.col(c) for c in by])).alias("metric_key") if by
            else F.lit(None).cast("string").alias("metric_key"),
            F.col(value).cast("double").alias("metric_value"), F.current_timestamp().alias("written_at"),
            F.lit(query_id).alias("query"), F.lit(int(batch_id)).cast("long").alias("batch_id"))
        replace_partitions(rows, path, ["metric_name", "query", "batch_id"])

    return run


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Latest value per (metric_name, window_start, window_end, metric_key): one aggregate."""
    rows = spark.read.parquet(path)
    latest = F.max_by(F.col("metric_value"), F.struct("written_at", "batch_id"))
    return (rows.groupBy("metric_name", "window_start", "window_end", "metric_key")
            .agg(latest.alias("metric_value")))
