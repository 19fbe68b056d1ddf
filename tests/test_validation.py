"""Validation edge cases: permissive JSON outcomes and the rule priority order."""

import json

import pytest

from orderflow.operators.dedup import with_event_time
from orderflow.operators.validate import classify, envelope_rows, parse_events, valid_events, validate

ENV = {
    "event_id": "E-1", "event_type": "order_created", "event_time": "2026-10-09T01:52:11.000Z",
    "schema_version": 1, "order_id": "ORD-1", "customer_id": "CUS-1",
    "payload": {"total_amount": 150.0, "currency": "MAD"},
}
PAY = {**ENV, "event_type": "payment_failed",
       "payload": {"payment_id": "PAY-1", "amount": 10.0, "currency": "MAD",
                   "reason": "payment_declined"}}
INV = {**ENV, "event_type": "inventory_rejected",
       "payload": {"sku": "SKU-1", "quantity": 1, "reason": "insufficient_stock"}}


def _with(base, **changes):
    doc = json.loads(json.dumps(base))
    for k, v in changes.items():
        if k.startswith("payload_"):
            name = k[len("payload_"):]
            if v is _DROP:
                doc["payload"].pop(name, None)
            else:
                doc["payload"][name] = v
        elif v is _DROP:
            doc.pop(k, None)
        else:
            doc[k] = v
    return json.dumps(doc)


_DROP = object()

CASES = [
    # (topic, key, raw_json, expected code or None for VALID)
    ("orders", "ORD-1", json.dumps(ENV)[:-20], "INVALID_JSON"),
    ("orders", "ORD-1", None, "MISSING_REQUIRED_FIELD"),
    ("orders", "ORD-1", "", "MISSING_REQUIRED_FIELD"),
    ("orders", "ORD-1", "null", "INVALID_JSON"),
    ("orders", "ORD-1", "[]", "INVALID_JSON"),
    ("orders", "ORD-1", "123", "INVALID_JSON"),
    ("orders", "ORD-1", "{}", "MISSING_REQUIRED_FIELD"),
    ("orders", "ORD-1", _with(ENV, payload="str"), "INVALID_JSON"),
    ("inventory-events", "ORD-1", _with(INV, payload_quantity=1.5), "INVALID_JSON"),
    ("inventory-events", "ORD-1", _with(INV, payload_quantity="3"), "INVALID_JSON"),
    ("orders", "ORD-1", _with(ENV, schema_version="1"), "INVALID_JSON"),
    ("orders", "ORD-1", json.dumps(ENV) + " trailing", None),
    ("orders", "ORD-1", _with(ENV, extra_field="x"), None),
    ("orders", "ORD-1", json.dumps(ENV).replace('"total_amount": 150.0', '"total_amount": NaN'), None),
    ("orders", "ORD-1", _with(ENV, payload_total_amount=0), "INVALID_ORDER_PAYLOAD"),
    ("orders", "ORD-1", _with(ENV, payload_total_amount=-5), "INVALID_ORDER_PAYLOAD"),
    ("orders", "ORD-1", _with(ENV, payload_total_amount=_DROP), "INVALID_ORDER_PAYLOAD"),
    ("orders", "ORD-1", _with(ENV, payload_currency=_DROP), "INVALID_ORDER_PAYLOAD"),
    ("orders", None, json.dumps(ENV), "INVALID_KAFKA_KEY"),
    ("orders", "ORD-2", json.dumps(ENV), "INVALID_KAFKA_KEY"),
    ("orders", "ORD-1", _with(ENV, schema_version=2), "UNSUPPORTED_SCHEMA_VERSION"),
    ("orders", "ORD-1", _with(ENV, schema_version=_DROP), "UNSUPPORTED_SCHEMA_VERSION"),
    ("payments", "ORD-1", json.dumps(ENV), "INVALID_TOPIC_EVENT_TYPE"),
    ("orders", "ORD-1", _with(ENV, event_type="order_shipped"), "INVALID_TOPIC_EVENT_TYPE"),
    ("orders", "ORD-9", _with(ENV, customer_id=_DROP), "MISSING_REQUIRED_FIELD"),
    ("payments", "ORD-1", _with(PAY, payload_reason=_DROP, payload_amount=0), "INVALID_PAYMENT_PAYLOAD"),
    ("payments", "ORD-1", _with(PAY, payload_reason=_DROP), "MISSING_PAYMENT_FAILURE_REASON"),
    ("inventory-events", "ORD-1", _with(INV, payload_reason=_DROP), "MISSING_INVENTORY_REJECTION_REASON"),
    ("inventory-events", "ORD-1", _with(INV, payload_quantity=0), "INVALID_INVENTORY_PAYLOAD"),
    ("orders", "ORD-1", _with(ENV, event_time="garbage"), None),
    ("orders", "ORD-1", _with(ENV, event_time="2026-10-09T02:52:11.000+01:00"), None),
    ("payments", "ORD-1", json.dumps(PAY), None),
    ("inventory-events", "ORD-1", json.dumps(INV), None),
]


@pytest.fixture(scope="module")
def classified(spark):
    rows = [(key, topic, 0, i, raw) for i, (topic, key, raw, _) in enumerate(CASES)]
    df = spark.createDataFrame(
        rows, "kafka_key string, topic string, partition int, offset long, raw_json string")
    return {r.offset: r for r in validate(df).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_rule(classified, i):
    expected = CASES[i][3]
    row = classified[i]
    assert row.validation_error == expected, (CASES[i], row.validation_error)
    assert row.validation_status == ("VALID" if expected is None else "INVALID")


def test_bad_event_time_is_dropped_later_not_raised(spark):
    df = spark.createDataFrame([("garbage",), ("",), ("2026-10-09T01:52:11.000Z",)], "event_time string")
    assert [r.event_time for r in with_event_time(df).collect()] == ["2026-10-09T01:52:11.000Z"]


def test_offset_is_honoured_and_converted_to_utc(spark):
    df = spark.createDataFrame([("2026-10-09T02:52:11.000+01:00",)], "event_time string")
    ts = with_event_time(df).selectExpr("cast(event_timestamp as string) AS s").first().s
    assert ts == "2026-10-09 01:52:11"


def test_filters_on_records_do_not_parse_them_again(spark):
    text = '{"event_id":"e1","event_type":"order_created","event_time":"2026-10-09T01:52:11Z","order_id":"ORD-1"}'
    records = spark.createDataFrame([("k", text), ("k", "{"), ("k", None), (None, "[]")], "key string, value string")
    rows = with_event_time(envelope_rows(records, "key")).filter("event_type = 'order_created' and order_id is not null")
    assert [(r.key, r.event_id, r.payload) for r in rows.collect()] == [("k", "e1", None)]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1, plan


def test_records_parsed_once_give_the_same_rows(spark):
    rows = [(key, topic, 0, i, raw) for i, (topic, key, raw, _) in enumerate(CASES)] + [("k", "orders", 0, 99, None)]
    topic_rows = spark.createDataFrame(
        rows, "kafka_key string, topic string, partition int, offset long, raw_json string").repartition(2)
    plain, once = (classify(parse_events(topic_rows, once=o)) for o in (False, True))
    assert plain.schema == once.schema
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, once.collect()))
    fields = with_event_time(valid_events(once)).select("event_id", "order_id", "payload.amount", "event_timestamp")
    plan = fields._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1, plan
