"""The validation rule table and its fold into one ``CASE WHEN`` column.

Rules are data: ``(code, predicate)`` pairs in priority order, each predicate a SQL boolean
expression over the parsed event columns.  ``classify_column`` folds them into a single
``CASE WHEN p1 THEN code1 WHEN p2 THEN code2 ... END`` (the first matching rule wins), parsed
once on the JVM side; the whole classification is one expression inside whole-stage codegen.
A caller may pass a different list (e.g. with ``future_event_rule()`` appended) without
touching the fold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import contract as C

Rule = tuple[str, str]


def _in(values: Sequence[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def topic_type_sql(topic: str = "topic", event_type: str = "event_type",
                   allowed: dict | None = None) -> str:
    """True when the event type belongs to the topic it was read from."""
    allowed = allowed or C.TOPIC_EVENT_TYPES
    return "(" + " OR ".join(f"({topic} = '{name}' AND {event_type} IN {_in(types)})"
                             for name, types in allowed.items()) + ")"


def topic_type_allowed(topic: str = "topic", event_type: str = "event_type",
                       allowed: dict | None = None) -> Column:
    return F.expr(topic_type_sql(topic, event_type, allowed))


# --- Fixed values: the validation rules, in priority order (first match wins) --------
RULES: list[Rule] = [
    (C.INVALID_JSON, "corrupt_record IS NOT NULL"),
    (C.MISSING_REQUIRED_FIELD,
     "event_id IS NULL OR event_type IS NULL OR event_time IS NULL OR order_id IS NULL "
     "OR customer_id IS NULL OR payload IS NULL"),
    (C.INVALID_KAFKA_KEY, "kafka_key IS NULL OR kafka_key <> order_id"),
    (C.UNSUPPORTED_SCHEMA_VERSION,
     f"schema_version IS NULL OR schema_version <> {C.SUPPORTED_SCHEMA_VERSION}"),
    (C.INVALID_TOPIC_EVENT_TYPE, f"NOT {topic_type_sql()}"),
    (C.INVALID_ORDER_PAYLOAD,
     f"event_type = '{C.ORDER_CREATED}' AND (payload.total_amount IS NULL "
     "OR payload.total_amount <= 0 OR payload.currency IS NULL)"),
    (C.INVALID_PAYMENT_PAYLOAD,
     f"event_type IN {_in(C.PAYMENT_TYPES)} AND (payload.payment_id IS NULL "
     "OR payload.amount IS NULL OR payload.amount <= 0 OR payload.currency IS NULL)"),
    (C.INVALID_INVENTORY_PAYLOAD,
     f"event_type IN {_in(C.INVENTORY_TYPES)} AND (payload.sku IS NULL "
     "OR payload.quantity IS NULL OR payload.quantity <= 0)"),
    (C.MISSING_PAYMENT_FAILURE_REASON,
     f"event_type = '{C.PAYMENT_FAILED}' AND payload.reason IS NULL"),
    (C.MISSING_INVENTORY_REJECTION_REASON,
     f"event_type = '{C.INVENTORY_REJECTED}' AND payload.reason IS NULL"),
]

RULE_CODES = [code for code, _ in RULES]


def classify_sql(rules: Sequence[Rule] = RULES) -> str:
    if not rules:
        return "CAST(NULL AS string)"
    whens = " ".join(f"WHEN ({predicate}) THEN '{code}'" for code, predicate in rules)
    return f"CASE {whens} END"


def classify_column(rules: Sequence[Rule] = RULES) -> Column:
    """The first failing rule's code, or NULL when every rule passes."""
    return F.expr(classify_sql(rules))


def status_column(error: Column) -> Column:
    return F.when(error.isNull(), F.lit(C.VALID)).otherwise(F.lit(C.INVALID))


def future_event_rule(tolerance: str = "1 hour") -> Rule:
    """Optional extra rule: reject an event time further than ``tolerance`` past now.

    Off by default (not in ``RULES``); it guards the watermark against one far-future event
    that would otherwise evict all state and make normal rows late.
    """
    return ("EVENT_TIME_IN_FUTURE",
            f"try_to_timestamp(event_time) > current_timestamp() + INTERVAL {tolerance}")
