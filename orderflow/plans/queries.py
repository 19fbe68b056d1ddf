"""Named queries: ``(spark, sf_dir) -> DataFrame``, one per operator family.

Each reads the given tables (the event log is derived from ``orders`` by Spark) and runs over
them whole.  Column names are fixed: the DuckDB oracles in ``oracle.py`` produce the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contract as C
from ..operators import audit as au
from ..operators import correlate as corr
from ..operators import dedup as dd
from ..operators import metrics as me
from ..operators import sequence as sq
from ..operators import states as st
from ..operators import validate as va
from ..session import scratch_path
from . import backfill
from . import history as hi
from .flow import EventFlow

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------- sources
@query
def decode_topic(spark, sf_dir):
    """The derived topic log, decoded (key, topic, partition, offset, text)."""
    return EventFlow(spark, sf_dir).topic_rows


@query
def topic_profile(spark, sf_dir):
    return au.topic_profile(EventFlow(spark, sf_dir).topic_rows)


# ---------------------------------------------------------------- validation
@query
def validation_status(spark, sf_dir):
    return EventFlow(spark, sf_dir).classified.select(
        "kafka_key", "topic", "partition", "offset", "event_id", "event_type", "order_id",
        "validation_status", "validation_error")


@query
def validation_errors_by_code(spark, sf_dir):
    return va.errors_by_code(EventFlow(spark, sf_dir).classified)


@query
def validation_counts(spark, sf_dir):
    return va.validation_counts(EventFlow(spark, sf_dir).classified)


@query
def dead_letter_records(spark, sf_dir):
    """Dead-letter documents (``rejected_at`` left out: it is the processing time)."""
    flow = EventFlow(spark, sf_dir)
    fields = va.dead_letter_fields(flow.classified, with_time=False)
    return fields.select(
        "key", "original_message", "error_reason", "source_topic", "source_partition",
        "source_offset",
        F.to_json(F.struct("original_message", "error_reason", "source_topic",
                           "source_partition", "source_offset")).alias("value"))


@query
def valid_records(spark, sf_dir):
    return va.valid_records(EventFlow(spark, sf_dir).classified)


# ---------------------------------------------------------------- event time
@query
def event_times(spark, sf_dir):
    """JSON-path extraction on forwarded valid records, then event-time parse + filter."""
    records = va.valid_records(EventFlow(spark, sf_dir).classified)
    keyed = dd.extract_event_keys(records)
    timed = dd.with_event_time(keyed)
    return timed.select("key", "event_id", "event_time", "event_timestamp")


@query
def deduplicated_events(spark, sf_dir):
    return EventFlow(spark, sf_dir).unique.select(
        "event_id", "kafka_key", "topic", "partition", "offset", "event_type", "order_id",
        "event_timestamp")


@query
def time_span(spark, sf_dir):
    return me.time_span(EventFlow(spark, sf_dir).unique)


# ---------------------------------------------------------------- domains
@query
def domain_orders(spark, sf_dir):
    return EventFlow(spark, sf_dir).domains[0]


@query
def domain_orders_allowed(spark, sf_dir):
    """The orders of an allow-list given as a table (F6): the urgent ones, by a semi-join."""
    flow = EventFlow(spark, sf_dir)
    keys = flow.table("orders").filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.concat(F.lit("ORD-"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("order_id"))
    return corr.split_domains(flow.unique, order_ids=keys)[0]


@query
def domain_payments(spark, sf_dir):
    return EventFlow(spark, sf_dir).domains[1]


@query
def domain_inventory(spark, sf_dir):
    return EventFlow(spark, sf_dir).domains[2]


# ---------------------------------------------------------------- correlation
@query
def order_payments(spark, sf_dir):
    o, p, _ = EventFlow(spark, sf_dir).domains
    return corr.order_payments(o, p)


@query
def payment_inventory(spark, sf_dir):
    """J2 alone: authorized payments with their inventory result inside the window."""
    o, p, i = EventFlow(spark, sf_dir).domains
    op = corr.order_payments(o, p).filter(F.col("payment_status") == C.PAYMENT_AUTHORIZED)
    inv = i.select("order_id", F.col("event_type").alias("inventory_status"), "sku",
                   F.col("reason").alias("inventory_reason"),
                   F.col("event_timestamp").alias("inventory_time"))
    return corr.interval_join(op, inv, "order_id", "payment_time", "inventory_time").select(
        "order_id", "payment_id", "payment_time", "inventory_status", "sku", "inventory_time")


@query
def correlated(spark, sf_dir):
    return EventFlow(spark, sf_dir).correlated()


@query
def correlated_branches(spark, sf_dir):
    """The failed and the authorized branch of the correlation, united by name."""
    rows = EventFlow(spark, sf_dir).correlated()
    failed = F.col("payment_status") == C.PAYMENT_FAILED
    return rows.filter(failed).unionByName(rows.filter(~failed))


@query
def correlated_chained(spark, sf_dir):
    """The same correlation in the stream shape: one order->payment join, one join to
    inventory results plus failed-payment markers."""
    return EventFlow(spark, sf_dir).correlated(shape="chained")


@query
def order_states(spark, sf_dir):
    return EventFlow(spark, sf_dir).states


@query
def status_counts(spark, sf_dir):
    return st.status_counts(EventFlow(spark, sf_dir).states)


@query
def completion_rate(spark, sf_dir):
    return me.completion_rate(EventFlow(spark, sf_dir).states)


@query
def completion_rate_by_order(spark, sf_dir):
    """The rate with every order counted once, by its current state."""
    return me.completion_rate(st.current_state(EventFlow(spark, sf_dir).history))


@query
def expected_state_check(spark, sf_dir):
    flow = EventFlow(spark, sf_dir)
    return st.expected_state_check(flow.states, flow.expected_states())


# ---------------------------------------------------------------- state records, ids, history
@query
def state_records(spark, sf_dir):
    return st.state_record(EventFlow(spark, sf_dir).states)


@query
def state_ids(spark, sf_dir):
    return st.with_state_id(EventFlow(spark, sf_dir).states).select(
        "order_id", "order_status", "state_id")


@query
def history_table(spark, sf_dir):
    """History after an at-least-once replay: every state batch delivered twice, read by key.

    The states are derived once and each row delivered twice (a union would derive them twice)."""
    delivered = EventFlow(spark, sf_dir).history.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2))))
    return st.upsert_view(delivered.drop("delivery")).select(*st.HISTORY_COLUMNS)


@query
def order_lookup(spark, sf_dir):
    """Point lookups by partition key, for the keys of every urgent order: the buckets that hold one
    of them are read, then a semi-join."""
    flow = EventFlow(spark, sf_dir)
    path = scratch_path(spark, "lookup-history")  # the written, bucketed history
    hi.write(st.upsert_view(flow.history), path, buckets=8)
    keys = flow.table("orders").filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.concat(F.lit("ORD-"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("order_id"))
    return hi.lookup_many(spark, path, keys)


@query
def current_state(spark, sf_dir):
    return st.current_state(EventFlow(spark, sf_dir).history)


@query
def events_by_order(spark, sf_dir):
    """Each order's events in (event time, event id) order with their 1-based position."""
    unique = EventFlow(spark, sf_dir).unique.select(
        "order_id", "event_timestamp", "event_id", "event_type", "topic")
    return sq.sequence_within(unique, "order_id", ["event_timestamp", "event_id"], "event_seq")


@query
def multi_state_orders(spark, sf_dir):
    """Orders for which the state stream emitted more than one state row."""
    return st.multi_state_orders(EventFlow(spark, sf_dir).history)


# ---------------------------------------------------------------- metrics
@query
def window_counts_by_order(spark, sf_dir):
    """Events per (5-min window, order) over valid, timed events (before dedup)."""
    return me.window_counts(EventFlow(spark, sf_dir).timed)


@query
def order_volume_5m(spark, sf_dir):
    return me.order_volume(EventFlow(spark, sf_dir).domains[0])


@query
def orders_per_minute(spark, sf_dir):
    return me.window_counts(EventFlow(spark, sf_dir).domains[0], width=C.MINUTE_WINDOW, by=(),
                            count_name="order_count")


@query
def payment_failure_rate_5m(spark, sf_dir):
    return me.payment_failure_rate(EventFlow(spark, sf_dir).domains[1])


@query
def metric_rows(spark, sf_dir):
    flow = EventFlow(spark, sf_dir)
    o, p, _ = flow.domains
    states = flow.states.withColumn("order_ts", F.try_to_timestamp(F.col("order_time")))
    return me.metric_rows(o, p, states)


# ---------------------------------------------------------------- log reports
@query
def audit_event_log(spark, sf_dir):
    return au.audit_event_log(EventFlow(spark, sf_dir).classified)


@query
def reconcile(spark, sf_dir):
    """Counts from the written stage tables: the log is derived and parsed once."""
    tables = backfill.run_backfill(spark, EventFlow(spark, sf_dir).topic_rows)
    return au.reconcile(*[backfill.read_table(spark, tables, n) for n in ("validated", "unique", "states")])


# ---------------------------------------------------------------- extensions
@query
def pending_orders(spark, sf_dir):
    flow = EventFlow(spark, sf_dir)
    o, p, i = flow.domains
    return au.pending_orders(o, p, i, flow.unique)


@query
def business_dedup(spark, sf_dir):
    """One event per business key (order_id, event_type, payment_id, sku)."""
    kept = dd.keep_first(dd.with_business_key(EventFlow(spark, sf_dir).unique), list(dd.BUSINESS_KEY),
                         ["event_timestamp", "event_id"])
    return kept.select(*dd.BUSINESS_KEY, "event_id", "event_timestamp")


# ---------------------------------------------------------------- the events table (P4, M1 on given data)
@query
def events_props(spark, sf_dir):
    ev = EventFlow(spark, sf_dir).table("events")
    return ev.select("event_id", "event_type",
                     F.get_json_object("props", "$.k").cast("int").alias("prop_k"))


@query
def events_window_counts(spark, sf_dir):
    ev = EventFlow(spark, sf_dir).table("events").withColumn("ts", F.col("ts").cast("timestamp"))
    return me.window_counts(ev, ts="ts", by=("event_type",), lateness=None)


def queries() -> dict[str, Query]:
    from .stream_queries import REGISTRY as streamed
    return {**REGISTRY, **streamed}
