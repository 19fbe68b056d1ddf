"""The event contract: topic names, event vocabulary, rule codes and default thresholds.

These are fixed values of the contract; results depend on them exactly.
"""

from __future__ import annotations

# --- Fixed values: topics -------------------------------------------------------------
TOPIC_ORDERS = "orders"
TOPIC_PAYMENTS = "payments"
TOPIC_INVENTORY = "inventory-events"
TOPIC_DEAD_LETTER = "dead-letter-events"
TOPIC_VALIDATED = "validated-events"
TOPIC_UNIQUE = "unique-events"
TOPIC_STATES = "order-states"

# --- Fixed values: event types --------------------------------------------------------
ORDER_CREATED = "order_created"
PAYMENT_AUTHORIZED = "payment_authorized"
PAYMENT_FAILED = "payment_failed"
INVENTORY_RESERVED = "inventory_reserved"
INVENTORY_REJECTED = "inventory_rejected"

PAYMENT_TYPES = (PAYMENT_AUTHORIZED, PAYMENT_FAILED)
INVENTORY_TYPES = (INVENTORY_RESERVED, INVENTORY_REJECTED)
EVENT_TYPES = (ORDER_CREATED,) + PAYMENT_TYPES + INVENTORY_TYPES

# Which event types each source topic may carry.
TOPIC_EVENT_TYPES = {
    TOPIC_ORDERS: (ORDER_CREATED,),
    TOPIC_PAYMENTS: PAYMENT_TYPES,
    TOPIC_INVENTORY: INVENTORY_TYPES,
}
SOURCE_TOPICS = tuple(TOPIC_EVENT_TYPES)

SUPPORTED_SCHEMA_VERSION = 1

# --- Fixed values: validation codes, in priority order --------------------------------
INVALID_JSON = "INVALID_JSON"
MISSING_REQUIRED_FIELD = "MISSING_REQUIRED_FIELD"
INVALID_KAFKA_KEY = "INVALID_KAFKA_KEY"
UNSUPPORTED_SCHEMA_VERSION = "UNSUPPORTED_SCHEMA_VERSION"
INVALID_TOPIC_EVENT_TYPE = "INVALID_TOPIC_EVENT_TYPE"
INVALID_ORDER_PAYLOAD = "INVALID_ORDER_PAYLOAD"
INVALID_PAYMENT_PAYLOAD = "INVALID_PAYMENT_PAYLOAD"
INVALID_INVENTORY_PAYLOAD = "INVALID_INVENTORY_PAYLOAD"
MISSING_PAYMENT_FAILURE_REASON = "MISSING_PAYMENT_FAILURE_REASON"
MISSING_INVENTORY_REJECTION_REASON = "MISSING_INVENTORY_REJECTION_REASON"

VALID = "VALID"
INVALID = "INVALID"

# --- Fixed values: order states -------------------------------------------------------
COMPLETED = "COMPLETED"
PAYMENT_FAILED_STATE = "PAYMENT_FAILED"
INVENTORY_REJECTED_STATE = "INVENTORY_REJECTED"
UNKNOWN = "UNKNOWN"
FINAL_STATUSES = (COMPLETED, PAYMENT_FAILED_STATE, INVENTORY_REJECTED_STATE)

# --- Default thresholds (parameters everywhere; these are the contract's values) -----
WATERMARK_DELAY = "10 minutes"
CORRELATION_WINDOW = "15 minutes"
VOLUME_WINDOW = "5 minutes"
RATE_WINDOW = "5 minutes"
MINUTE_WINDOW = "1 minute"
