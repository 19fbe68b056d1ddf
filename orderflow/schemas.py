"""Declared schemas of the event contract (no inference, no registry)."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# The names and types of the wire contract, which records carry.
CORRUPT_COLUMN = "_corrupt_record"

# Payload: one wide union struct for every event type, all nullable.
PAYLOAD = StructType([
    StructField("total_amount", DoubleType()),
    StructField("amount", DoubleType()),
    StructField("currency", StringType()),
    StructField("payment_id", StringType()),
    StructField("sku", StringType()),
    StructField("quantity", IntegerType()),
    StructField("reason", StringType()),
])

# Envelope shared by every event.
ENVELOPE = StructType([
    StructField("event_id", StringType()),
    StructField("event_type", StringType()),
    StructField("event_time", StringType()),
    StructField("schema_version", IntegerType()),
    StructField("order_id", StringType()),
    StructField("customer_id", StringType()),
    StructField("payload", PAYLOAD),
])

# Envelope with the permissive-mode capture column.
ENVELOPE_PERMISSIVE = StructType(ENVELOPE.fields + [StructField(CORRUPT_COLUMN, StringType())])

# A decoded topic row: what a Kafka record looks like once key/value are text.
TOPIC_ROW = StructType([
    StructField("kafka_key", StringType()),
    StructField("topic", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("raw_json", StringType()),
])

# Order state as published between the business job and the history sink.
STATE = StructType([
    StructField("order_id", StringType()),
    StructField("customer_id", StringType()),
    StructField("order_amount", DoubleType()),
    StructField("order_time", StringType()),
    StructField("payment_status", StringType()),
    StructField("inventory_status", StringType()),
    StructField("order_status", StringType()),
])

STATE_COLUMNS = [f.name for f in STATE.fields]
