"""The staged streaming pipeline: validation -> dedup -> business states -> history.

Each stage is one Structured Streaming query with its own checkpoint, reading the previous
stage's durable log; ``run_pipeline`` runs them in order with ``availableNow`` triggers (drain
what is there, then stop), which is how a scheduled deployment runs them.  The same operator
functions as the batch path are used; only ``dedup`` and ``correlate`` switch on
``isStreaming`` (watermarked dedup, watermarked interval joins).

The logs between the stages are written by the file sink, whose commit log makes a replayed
micro-batch count once downstream; ``target=kafka_target(...)`` writes them to topics instead.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import contract as C
from ..operators import correlate as corr
from ..operators import dedup as dd
from ..operators import metrics as me
from ..operators import states as st
from ..operators import validate as va
from ..session import pin_utc, scratch_path
from ..sources import topics as tp
from . import sinks
from .totals import totals, watch


def run_to_end(query: StreamingQuery) -> StreamingQuery:
    """Wait for an ``availableNow`` query; its failure is raised by the wait."""
    query.awaitTermination()
    return query


def log_target(path: str, partition_by: str | None = None) -> dict:
    """Where a stage's records go: a log of files under ``path``."""
    return {"format": "parquet", "options": {"path": path, "compression": "zstd"}, "partition_by": partition_by}


def kafka_target(bootstrap: str, topic: str) -> dict:
    """Where a stage's records go: a Kafka topic (needs the connector on the classpath)."""
    return {"format": "kafka", "options": tp.kafka_sink_options(bootstrap, topic), "partition_by": None}


def _target(where: str | dict, partition_by: str | None = None) -> dict:
    return log_target(where, partition_by) if isinstance(where, str) else where


def _start(df: DataFrame, checkpoint: str, callback=None, mode: str = "append",
           trigger: dict | None = None, target: dict | None = None) -> StreamingQuery:
    """Start a query into ``target`` or, by micro-batch, into ``callback(batch, id, query id)``."""
    watch(df.sparkSession)
    w = (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"availableNow": True})))
    if target is not None:
        w = w.format(target["format"]).options(**target["options"])
        return (w.partitionBy(target["partition_by"]) if target["partition_by"] else w).start()
    started, query_id = threading.Event(), []

    def run(batch: DataFrame, batch_id: int) -> None:
        if not started.wait(600):
            raise TimeoutError("the query was not handed over within 600 s of its first micro-batch")
        callback(batch, batch_id, query_id[0])

    query = w.foreachBatch(run).start()
    query_id.append(str(query.id))
    started.set()
    return query


# ----------------------------------------------------------------------------- stage 1
def validation_stream(topic_rows: DataFrame, rules=None) -> DataFrame:
    return va.validate(topic_rows) if rules is None else va.validate(topic_rows, rules)


def run_validation(topic_rows: DataFrame, routed_log: str | dict, checkpoint: str,
                   trigger: dict | None = None) -> StreamingQuery:
    """Job 1: classify every record into one log partitioned by ``route`` (VALID: the forwarded
    record, INVALID: its dead-letter document); the counts ride along as observed metrics.

    Into a topic instead of a log, only the valid records go; ``run_dead_letters`` sends the others.
    """
    records = va.routed_records(observe_validation(validation_stream(topic_rows)))
    target = _target(routed_log, "route")
    if target["format"] == "kafka":
        records = records.filter(F.col("route") == C.VALID).select("key", "value")
    return _start(records, checkpoint, trigger=trigger, target=target)


def run_dead_letters(topic_rows: DataFrame, target: str | dict, checkpoint: str,
                     trigger: dict | None = None) -> StreamingQuery:
    """The dead letters alone (the second writer where the targets are topics)."""
    return _start(va.dead_letter_records(validation_stream(topic_rows)), checkpoint, trigger=trigger,
                  target=_target(target))


# ----------------------------------------------------------------------------- stage 2
def dedup_stream(records: DataFrame, lateness: str = C.WATERMARK_DELAY,
                 spread: int | None = None) -> DataFrame:
    """Forwarded ``(key, value)`` -> event id / time by JSON path -> watermarked dedup
    (``spread`` > 1: two-level dedup that splits the copies of a hot event id)."""
    keyed = dd.with_event_time(dd.extract_event_keys(records.select(
        F.col("key").alias("kafka_key"), F.col("value").alias("raw_json")), "raw_json"))
    return dd.dedup(keyed, lateness=lateness, spread=spread).select(
        F.col("kafka_key").alias("key"), F.col("raw_json").alias("value"), "event_id",
        "event_timestamp")


def run_dedup(records: DataFrame, unique_path: str | dict, checkpoint: str,
              lateness: str = C.WATERMARK_DELAY, trigger: dict | None = None,
              spread: int | None = None) -> StreamingQuery:
    """Job 2: drop technical duplicates by event_id under the watermark."""
    return _start(dedup_stream(records, lateness, spread).select("key", "value"), checkpoint,
                  trigger=trigger, target=_target(unique_path))


# ----------------------------------------------------------------------------- stage 3
def business_stream(records: DataFrame, within: str = C.CORRELATION_WINDOW, lateness: str = C.WATERMARK_DELAY,
                    shared: bool = True, bucketed: bool = True) -> DataFrame:
    """Unique ``(key, value)`` events -> order states (append).

    ``shared``: one watermark over all events, as the dedup stage before has (a domain without
    events keeps no state alive); else one per domain under the ``min`` policy.
    """
    events = dd.with_event_time(va.envelope_rows(records)).filter(F.col("event_id").isNotNull()
                                                & F.col("order_id").isNotNull())
    o, p, i = corr.split_domains(corr.shared_watermark(events, lateness) if shared else events)
    correlated = corr.correlate(o, p, i, within=within, lateness=None if shared else lateness, shape="chained",
                                bucketed=bucketed)
    return st.order_status(correlated, with_decision=True)


def run_business(records: DataFrame, states_path: str | dict, checkpoint: str,
                 within: str = C.CORRELATION_WINDOW, lateness: str = C.WATERMARK_DELAY,
                 trigger: dict | None = None, shared: bool = True, bucketed: bool = True) -> StreamingQuery:
    """Job 3: correlate order -> payment -> inventory and publish state records."""
    states = observe_states(business_stream(records, within, lateness, shared, bucketed))
    return _start(st.state_record(states), checkpoint, trigger=trigger, target=_target(states_path))


# ----------------------------------------------------------------------------- stage 4
def run_history(records: DataFrame, history_path: str, checkpoint: str,
                trigger: dict | None = None) -> StreamingQuery:
    """Job 4: parse state records and upsert them under (order_id, state_id)."""
    return _start(st.parse_states(records), checkpoint, sinks.upsert_history(history_path),
                  trigger=trigger)


def run_current(records: DataFrame, table_path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """State records -> the table of every order's current state."""
    return _start(st.parse_states(records), checkpoint, sinks.upsert_current(table_path), trigger=trigger)


# ----------------------------------------------------------------------------- pipeline
@dataclass
class PipelinePaths:
    root: str

    def __post_init__(self):
        self.root = self.root.rstrip("/")
        self.observed: dict = {}

    def log(self, name: str) -> str:
        return f"{self.root}/logs/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    @property
    def routed(self):
        """Validated records and dead letters, partitioned by ``route``."""
        return self.log(C.TOPIC_VALIDATED)

    @property
    def unique(self):
        return self.log(C.TOPIC_UNIQUE)

    @property
    def states(self):
        return self.log(C.TOPIC_STATES)

    @property
    def history(self):
        return f"{self.root}/tables/order_state_history"


def run_pipeline(spark: SparkSession, topic_rows: DataFrame, root: str | None = None,
                 max_files_per_trigger: int | None = None,
                 dedup_spread: int | None = 8, max_bytes_per_trigger: int | None = tp.BATCH_BYTES) -> PipelinePaths:
    """Run the four stages in order, each draining its input (``availableNow``).

    ``root`` defaults to a fresh folder under the session's shared checkpoint folder; re-running
    with the same ``root`` resumes from the checkpoints (no new input -> no new output).
    ``dedup_spread`` splits the copies of a hot event id over that many state partitions
    before the final dedup (None: single-level dedup).  A backlog is drained in micro-batches of
    ``max_bytes_per_trigger``, so the watermark moves and state is evicted on the way.
    """
    pin_utc(spark)
    paths = PipelinePaths(root or scratch_path(spark, "pipeline"))
    limits = {"max_files_per_trigger": max_files_per_trigger, "max_bytes_per_trigger": max_bytes_per_trigger}
    q = run_to_end(run_validation(topic_rows, paths.routed, paths.checkpoint("validation")))
    paths.observed["validation"] = observed_total(q, "validation")
    run_to_end(run_dedup(tp.key_value_log(spark, paths.routed, route=C.VALID, **limits),
                         paths.unique, paths.checkpoint("deduplication"), spread=dedup_spread))
    q = run_to_end(run_business(tp.key_value_log(spark, paths.unique, **limits),
                                paths.states, paths.checkpoint("business")))
    paths.observed["states"] = observed_total(q, "states")
    run_to_end(run_history(tp.key_value_log(spark, paths.states, **limits),
                           paths.history, paths.checkpoint("history")))
    return paths


# ----------------------------------------------------------------------------- metrics
def _events(records: DataFrame) -> DataFrame:
    """Unique ``(key, value)`` events -> parsed and timed."""
    return dd.with_event_time(va.envelope_rows(records))


def volume_stream(records: DataFrame, width: str = C.VOLUME_WINDOW,
                  lateness: str = C.WATERMARK_DELAY) -> DataFrame:
    """Order volume per tumbling window over unique ``(key, value)`` events (update mode)."""
    return me.order_volume(_events(records).filter(F.col("event_type") == C.ORDER_CREATED),
                           width=width, lateness=lateness)


def failure_stream(records: DataFrame, width: str = C.RATE_WINDOW,
                   lateness: str = C.WATERMARK_DELAY) -> DataFrame:
    """Payment failure rate per window over unique ``(key, value)`` events (update mode)."""
    return me.payment_failure_rate(_events(records).filter(F.col("event_type").isin(*C.PAYMENT_TYPES)),
                                   width=width, lateness=lateness)


def completion_stream(states: DataFrame) -> DataFrame:
    """Running completion rate over the state stream: a stateful global aggregate kept in the
    checkpoint (survives restarts), emitted in update mode."""
    return me.completion_rate(states)


def _run_metric(rows: DataFrame, metrics_path: str, name: str, value: str, checkpoint: str,
                trigger: dict | None) -> StreamingQuery:
    return _start(rows, checkpoint, sinks.upsert_metrics(metrics_path, name, value), mode="update",
                  trigger=trigger)


def run_volume(records: DataFrame, metrics_path: str, checkpoint: str,
               width: str = C.VOLUME_WINDOW, lateness: str = C.WATERMARK_DELAY,
               trigger: dict | None = None, name: str = "order_volume_5m") -> StreamingQuery:
    """Order volume per window as durable metric rows."""
    return _run_metric(volume_stream(records, width, lateness), metrics_path, name, "order_count",
                       checkpoint, trigger)


def run_orders_per_minute(records: DataFrame, metrics_path: str, checkpoint: str,
                          lateness: str = C.WATERMARK_DELAY, trigger: dict | None = None) -> StreamingQuery:
    """Orders per minute as durable metric rows."""
    return run_volume(records, metrics_path, checkpoint, C.MINUTE_WINDOW, lateness, trigger, "orders_per_minute")


def run_failure_rate(records: DataFrame, metrics_path: str, checkpoint: str,
                     width: str = C.RATE_WINDOW, lateness: str = C.WATERMARK_DELAY,
                     trigger: dict | None = None) -> StreamingQuery:
    """Payment failure rate per window as durable metric rows."""
    return _run_metric(failure_stream(records, width, lateness), metrics_path, "payment_failure_rate_5m",
                       "failure_rate_pct", checkpoint, trigger)


def run_completion(state_records: DataFrame, metrics_path: str, checkpoint: str,
                   trigger: dict | None = None) -> StreamingQuery:
    """Running completion rate over the state log as one durable metric row."""
    return _run_metric(completion_stream(st.parse_states(state_records)), metrics_path, "completion_rate",
                       "completion_rate_pct", checkpoint, trigger)


def observed_event_time(query: StreamingQuery) -> dict:
    """The last progress' event-time block (``watermark``, ``max``, ``min``, ``avg``)."""
    progress = query.lastProgress or {}
    return dict(progress.get("eventTime", {}))


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows dropped as late by the stateful operators, over all micro-batches of the run."""
    return totals(query).dropped


# ----------------------------------------------------------------------------- observation
def observe_validation(classified: DataFrame, name: str = "validation") -> DataFrame:
    """Attach per-batch counters (valid / invalid / total) as observed metrics.

    Replaces per-batch ``show``/``count`` inspection jobs: the counters ride along with the
    query's own execution and appear in ``lastProgress["observedMetrics"][name]``.
    """
    return classified.observe(
        name,
        F.count_if(F.col("validation_status") == C.VALID).alias("valid"),
        F.count_if(F.col("validation_status") == C.INVALID).alias("invalid"),
        F.count(F.lit(1)).alias("total"))


def observe_states(states: DataFrame, name: str = "states") -> DataFrame:
    """Per-batch state counters, including the UNKNOWN monitor."""
    return states.observe(
        name,
        F.count(F.lit(1)).alias("states"),
        F.count_if(F.col("order_status") == C.UNKNOWN).alias("unknown"),
        F.count_if(F.col("order_status") == C.COMPLETED).alias("completed"))


def observed_total(query: StreamingQuery, name: str) -> dict:
    """Observed counters ``name`` summed over all micro-batches of the run."""
    return dict(totals(query).observed.get(name, {}))


def log_totals(spark: SparkSession, paths: PipelinePaths) -> dict:
    """What the stages delivered so far, counted from their logs: valid, invalid and total records,
    states and how many of them are unknown or completed.

    The sinks' commit logs name each batch's files once, so a replayed batch counts once, and the
    sums are right after any number of restarts of the driver.  Of a log without files nothing is counted.
    """
    def counted(path: str, columns: str, *counts: Column) -> dict:
        rows = spark.read.schema(columns).parquet(path)
        return rows.agg(*counts).first().asDict()

    total, status = F.count(F.lit(1)), F.get_json_object("value", "$.order_status")
    return counted(paths.routed, "key string, value string, route string",
                   F.count_if(F.col("route") == C.VALID).alias("valid"),
                   F.count_if(F.col("route") == C.INVALID).alias("invalid"), total.alias("total")) | counted(
        paths.states, "key string, value string", total.alias("states"),
        F.count_if(status == C.UNKNOWN).alias("unknown"), F.count_if(status == C.COMPLETED).alias("completed"))


def observed(query: StreamingQuery, name: str) -> dict:
    """The latest observed metrics row ``name`` over the recorded progress."""
    for progress in reversed(query.recentProgress or []):
        value = (progress.get("observedMetrics") or {}).get(name)
        if value:
            return value.asDict() if hasattr(value, "asDict") else dict(value)
    return {}


# ----------------------------------------------------------------------------- extensions
def business_dedup_stream(events: DataFrame, lateness: str = C.WATERMARK_DELAY) -> DataFrame:
    """Business-level dedup on a stream: one event per business key (``dd.BUSINESS_KEY``) within
    the watermark (technical dedup is by event_id; this also drops re-sent business facts with
    fresh ids)."""
    return dd.dedup(dd.with_business_key(events), keys=dd.BUSINESS_KEY, lateness=lateness)


def run_business_dedup(records: DataFrame, unique_path: str | dict, checkpoint: str,
                       lateness: str = C.WATERMARK_DELAY, trigger: dict | None = None) -> StreamingQuery:
    """Forward the first ``(key, value)`` event of each business fact within the watermark."""
    timed = dd.with_event_time(va.envelope_rows(records, "key", "value"))
    return _start(business_dedup_stream(timed, lateness).select("key", "value"), checkpoint, trigger=trigger,
                  target=_target(unique_path))


def pending_stream(events: DataFrame, within: str = C.CORRELATION_WINDOW,
                   lateness: str = C.WATERMARK_DELAY) -> DataFrame:
    """Orders whose payment window closed without a payment, emitted as EXPIRED once the
    watermark passes ``order_time + within``.

    A left-outer interval join: the unmatched side is released by the watermark, so its state
    stays bounded.  The watermark is shared by all events (``shared_watermark``), so a quiet domain
    (no payments for a while) does not hold back the other side's eviction.  ``pending.expired_orders``
    knows the second reason as well.
    """
    timed = corr.shared_watermark(events, lateness)
    o = timed.filter(F.col("event_type") == C.ORDER_CREATED).select(
        "order_id", F.col("event_timestamp").alias("order_time"))
    p = timed.filter(F.col("event_type").isin(*C.PAYMENT_TYPES)).select(
        "order_id", F.col("event_timestamp").alias("payment_time"))
    joined = corr.interval_join(o, p, "order_id", "order_time", "payment_time", within, how="left")
    return (joined.filter(F.col("payment_time").isNull())
            .select("order_id", "order_time", F.lit("AWAITING_PAYMENT").alias("pending_reason"),
                    F.lit("EXPIRED").alias("pending_status")))
