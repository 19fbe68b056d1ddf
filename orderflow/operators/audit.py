"""Reports over the event log: topic profile, self-audit, stage reconciliation, pending orders.

Each report is a handful of aggregates (partial per task, tiny results) put into long form
with ``stack``; nothing is collected to drive the computation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contract as C
from ..functions.times import interval
from . import correlate as corr


def topic_profile(topic_rows: DataFrame) -> DataFrame:
    """Rows, offset range and NULL keys / values per (topic, partition)."""
    return topic_rows.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("offset").alias("min_offset"),
        F.max("offset").alias("max_offset"),
        F.count_if(F.col("kafka_key").isNull()).alias("null_keys"),
        F.count_if(F.col("raw_json").isNull()).alias("null_values"),
    )


def _long_form(wide: DataFrame, names: list[str], key: str, value: str) -> DataFrame:
    """One-row frame with columns ``names`` -> rows ``(key, value)`` (a ``stack``)."""
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return wide.select(F.expr(f"stack({len(names)}, {pairs}) as ({key}, {value})"))


def audit_event_log(classified: DataFrame) -> DataFrame:
    """The event-log self-check, one row per check with its violation count.

    Checks: unparseable documents, missing envelope fields, unknown event types,
    unsupported schema version, event time text not in UTC ``Z`` form, surplus copies of an
    event id, and orders seen with more than one customer.

    One scan and one shuffle of the whole log: a GROUPING SETS aggregate over ``(event_id)`` and
    ``(order_id)`` (partial aggregation per grouping set before the shuffle), then one conditional
    aggregate over its groups that gives all counts at once.
    """
    parsed = F.col("corrupt_record").isNull() & F.col("raw_json").isNotNull()
    envelope_missing = (F.col("event_id").isNull() | F.col("event_type").isNull()
                        | F.col("event_time").isNull() | F.col("order_id").isNull()
                        | F.col("customer_id").isNull() | F.col("payload").isNull()
                        | F.col("schema_version").isNull())
    flags = {
        "unparseable_json": ~parsed,
        "missing_envelope_field": parsed & envelope_missing,
        "unknown_event_type": parsed & F.col("event_type").isNotNull()
        & ~F.col("event_type").isin(*C.EVENT_TYPES),
        "unsupported_schema_version": parsed & F.col("schema_version").isNotNull()
        & (F.col("schema_version") != C.SUPPORTED_SCHEMA_VERSION),
        "event_time_not_utc": parsed & F.col("event_time").isNotNull()
        & ~F.col("event_time").endswith("Z"),
    }
    rows = classified.select("event_id", "order_id", "customer_id",
                             *[F.coalesce(c, F.lit(False)).cast("long").alias(n) for n, c in flags.items()])
    grouped = (rows.groupingSets([["event_id"], ["order_id"]], "event_id", "order_id")
               .agg(F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n"),
                    F.min("customer_id").alias("least"), F.max("customer_id").alias("most"),
                    *[F.sum(n).alias(n) for n in flags]))
    # grouping_id bits follow (event_id, order_id); a set bit = not grouped by it
    by_event, by_order = F.col("gid") == 1, F.col("gid") == 2
    surplus = F.sum(F.when(by_event & F.col("event_id").isNotNull(), F.col("n") - 1))
    report = grouped.agg(
        *[F.coalesce(F.sum(F.when(by_event, F.col(n))), F.lit(0)).cast("long").alias(n) for n in flags],
        F.coalesce(surplus, F.lit(0)).cast("long").alias("surplus_event_copies"),
        F.count_if(by_order & F.col("order_id").isNotNull() & (F.col("least") != F.col("most")))
        .alias("orders_with_many_customers"))
    return _long_form(report, [*flags, "surplus_event_copies", "orders_with_many_customers"],
                      "check_name", "violations")


def reconcile(classified: DataFrame, unique: DataFrame, states: DataFrame) -> DataFrame:
    """Row counts per pipeline stage, plus the events the derived states imply
    (every state has an order and a payment, completed and rejected ones also an inventory
    result)."""
    a = classified.agg(
        F.count(F.lit(1)).alias("topic_rows"),
        F.count_if(F.col("validation_status") == C.VALID).alias("valid_events"),
        F.count_if(F.col("validation_status") == C.INVALID).alias("invalid_events"))
    b = unique.agg(
        F.count(F.lit(1)).alias("unique_events"),
        F.count_if(F.col("event_type") == C.ORDER_CREATED).alias("unique_orders"),
        F.count_if(F.col("event_type").isin(*C.PAYMENT_TYPES)).alias("unique_payments"),
        F.count_if(F.col("event_type").isin(*C.INVENTORY_TYPES)).alias("unique_inventory"))
    c = states.agg(
        F.count(F.lit(1)).alias("order_states"),
        F.count_if(F.col("order_status") == C.COMPLETED).alias("completed_states"),
        F.count_if(F.col("order_status") == C.PAYMENT_FAILED_STATE).alias("payment_failed_states"),
        F.count_if(F.col("order_status") == C.INVENTORY_REJECTED_STATE)
        .alias("inventory_rejected_states"))
    c = c.withColumn("events_implied_by_states",
                     2 * F.col("order_states") + F.col("completed_states")
                     + F.col("inventory_rejected_states"))
    return (_long_form(a, ["topic_rows", "valid_events", "invalid_events"], "stage", "row_count")
            .unionByName(_long_form(b, ["unique_events", "unique_orders", "unique_payments",
                                        "unique_inventory"], "stage", "row_count"))
            .unionByName(_long_form(c, ["order_states", "completed_states",
                                        "payment_failed_states", "inventory_rejected_states",
                                        "events_implied_by_states"], "stage", "row_count")))


def pending_orders(orders: DataFrame, payments: DataFrame, inventory: DataFrame,
                   events: DataFrame, within: str = C.CORRELATION_WINDOW,
                   lateness: str = C.WATERMARK_DELAY) -> DataFrame:
    """Orders without any state: awaiting a payment or an inventory result, and whether the
    wait is over (EXPIRED: the matching window closed before the watermark, i.e. the latest
    event time minus the allowed lateness) or not (PENDING).

    One pass of the correlation joins (``payment_outcomes``), one aggregate per order, one
    left join back to the orders; the watermark is a scalar subquery (one value), not a
    collect or a cross join.
    """
    outcomes = (corr.payment_outcomes(orders, payments, inventory, within)
                .groupBy("order_id")
                .agg(F.max(F.col("has_state").cast("int")).alias("_has_state"),
                     F.max(F.when(F.col("payment_status") == C.PAYMENT_AUTHORIZED,
                                  F.col("payment_time"))).alias("last_payment_time")))
    watermark = events.agg(F.max("event_timestamp")).scalar() - interval(lateness)
    out = (orders.join(outcomes, "order_id", "left")
           .filter(F.coalesce(F.col("_has_state"), F.lit(0)) == 0))
    awaiting_inventory = F.col("last_payment_time").isNotNull()
    deadline = F.when(awaiting_inventory, F.col("last_payment_time") + interval(within)) \
        .otherwise(F.col("event_timestamp") + interval(within))
    return out.select(
        "order_id",
        F.col("event_timestamp").alias("order_time"),
        F.when(awaiting_inventory, F.lit("AWAITING_INVENTORY"))
        .otherwise(F.lit("AWAITING_PAYMENT")).alias("pending_reason"),
        F.when(deadline < watermark, F.lit("EXPIRED")).otherwise(F.lit("PENDING"))
        .alias("pending_status"),
    )
