"""Derive a topic-shaped event log from an ``orders`` table.

Each order row becomes its order, payment(s) and inventory events as Kafka-like records
(``kafka_key, topic, partition, offset, raw_json``), with the load mix of the commerce
scenario (75 % completed, 15 % payment failed, 10 % inventory rejected), boundary cases of
the correlation windows, technical duplicates and malformed or contract-breaking events.

The derivation is one narrow projection + ``explode`` over the scan: no shuffle, so it runs
at the speed of the ``orders`` scan and grows with it.  All rules are modular arithmetic on
``o_orderkey`` (``k``):

* scenario ``k % 20``: 0-14 authorized + reserved, 15-17 failed, 18-19 authorized + rejected
* payment gap in seconds: ``k % 97`` = 5 -> 960, 6 -> 900, 7 -> -1, else ``2 + k % 7``
* inventory gap after the payment: ``k % 101`` = 5 -> 901, 6 -> 900, 7 -> no event,
  else ``2 + k % 5``
* a second payment of the same type 1 s later when ``k % 103 = 5``
* the order event is sent twice (same text, next offset) when ``k % 50 = 0``
* the payment is sent again 1 s later under another event id when ``k % 107 = 3`` (by another
  customer on odd orders): the same business fact twice
* a failed payment is followed by an authorized one and a reservation a minute later when
  ``k % 29 = 4``
* a second SKU is reserved 1 s after the first when ``k % 113 = 6``
* anomalies by ``r = k % 211`` (see ``ANOMALIES``)
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import contract as C

# --- Fixed values: anomaly slots by r = k % 211 ----------------------------------------
ANOMALIES = {
    1: "order JSON cut before the payload value (INVALID_JSON)",
    2: "order without customer_id (MISSING_REQUIRED_FIELD)",
    3: "order key 'BAD-' || k (INVALID_KAFKA_KEY)",
    4: "order schema_version 2 (UNSUPPORTED_SCHEMA_VERSION)",
    5: "order sent on the payments topic (INVALID_TOPIC_EVENT_TYPE)",
    6: "order total_amount 0 (INVALID_ORDER_PAYLOAD)",
    7: "payments without currency (INVALID_PAYMENT_PAYLOAD)",
    8: "inventory quantity 0 (INVALID_INVENTORY_PAYLOAD)",
    9: "failed payment without reason (MISSING_PAYMENT_FAILURE_REASON)",
    10: "rejected inventory without reason (MISSING_INVENTORY_REJECTION_REASON)",
    11: "inventory quantity as the text \"1\" (INVALID_JSON)",
    12: "order value NULL (MISSING_REQUIRED_FIELD)",
    13: "order event_time 'not-a-time' (valid, dropped at event-time parse)",
    14: "order of type 'order_updated' (INVALID_TOPIC_EVENT_TYPE)",
    15: "order of 12500000.5 (valid; a large amount in the state id)",
}
ANOMALY_MODULUS = 211
DUPLICATE_MODULUS = 50
SECOND_PAYMENT_MODULUS = 103
RESENT_MODULUS, RECOVERY_MODULUS, SECOND_SKU_MODULUS = 107, 29, 113
LARGE_AMOUNT = "12500000.5"
CURRENCY = "MAD"
PAYMENT_FAILED_REASON = "payment_declined"
INVENTORY_REJECTED_REASON = "insufficient_stock"

# Offset slots within one order's block of 16 offsets.
SLOT_ORDER, SLOT_ORDER_COPY, SLOT_PAYMENT, SLOT_PAYMENT_2, SLOT_INVENTORY = 0, 1, 2, 3, 4
SLOT_RESENT, SLOT_RECOVERY, SLOT_RECOVERY_INVENTORY, SLOT_SECOND_SKU = 5, 6, 7, 8
OFFSET_STRIDE = 16


def _iso(epoch_seconds_sql: str) -> str:
    return f"date_format(timestamp_seconds({epoch_seconds_sql}), \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")"


def _doc(*parts: str) -> str:
    """One flat ``concat`` of literal pieces and value expressions (a single allocation per
    document; optional members are ``CASE ... ELSE ''`` pieces)."""
    return "concat(" + ", ".join(parts) + ")"


def _lit(text: str) -> str:
    return "'" + text.replace("'", "\\'") + "'"


def derive_event_log(orders: DataFrame) -> DataFrame:
    """Topic rows ``(kafka_key, topic, partition, offset, raw_json)`` derived from ``orders``.

    Two projections written as SQL expressions (each parsed once on the JVM side): the
    per-order values, then one ``inline`` of the order's events, each a ``CASE WHEN present``
    so a document is only built for an event that exists.  Documents are compact JSON with a
    fixed key order: envelope (event_id, event_type, event_time, schema_version, order_id,
    customer_id) then payload.
    """
    base = orders.selectExpr(
        "o_orderkey AS k",
        "cast(o_orderkey AS string) AS ks",
        f"o_orderkey % {ANOMALY_MODULUS} AS r",
        "o_orderkey % 20 >= 15 AND o_orderkey % 20 < 18 AS failed",
        "o_orderkey % 20 >= 18 AS rejected",
        "concat('ORD-', lpad(cast(o_orderkey AS string), 9, '0')) AS order_id",
        "concat('CUS-', cast(o_custkey AS string)) AS customer_id",
        "concat('PAY-', lpad(cast(o_orderkey AS string), 9, '0')) AS payment_id",
        "cast(o_totalprice AS string) AS price",
        "unix_seconds(cast(o_orderdate AS timestamp)) + o_orderkey % 86400 AS t0",
        """CASE WHEN o_orderkey % 97 = 5 THEN 960 WHEN o_orderkey % 97 = 6 THEN 900
                WHEN o_orderkey % 97 = 7 THEN -1 ELSE 2 + o_orderkey % 7 END AS pay_gap""",
        """CASE WHEN o_orderkey % 101 = 5 THEN 901 WHEN o_orderkey % 101 = 6 THEN 900
                ELSE 2 + o_orderkey % 5 END AS inv_gap""",
        "o_orderkey % 101 <> 7 AS inv_present",
    )

    def envelope(event_id_prefix: str, event_type: str, event_time: str, version: str,
                 customer: str) -> list[str]:
        return [_lit('{"event_id":"' + event_id_prefix), "ks",
                _lit('","event_type":"'), event_type,
                _lit('","event_time":"'), event_time,
                _lit('","schema_version":'), version,
                _lit(',"order_id":"'), "order_id", _lit('"'), customer,
                _lit(',"payload":')]

    order_json = f"""CASE WHEN r = 12 THEN CAST(NULL AS string) ELSE {_doc(
        *envelope("O-", f"CASE WHEN r = 14 THEN 'order_updated' ELSE {_lit(C.ORDER_CREATED)} END",
                  f"CASE WHEN r = 13 THEN 'not-a-time' ELSE {_iso('t0')} END",
                  "CASE WHEN r = 4 THEN '2' ELSE '1' END",
                  """CASE WHEN r = 2 THEN '' ELSE concat(',"customer_id":"', customer_id, '"') END"""),
        f"""CASE WHEN r = 1 THEN '' ELSE concat('{{"total_amount":',
            CASE WHEN r = 6 THEN '0.0' WHEN r = 15 THEN '{LARGE_AMOUNT}' ELSE price END, {_lit(',"currency":"' + CURRENCY + '"}}')}) END""")} END"""
    order_key = "CASE WHEN r = 3 THEN concat('BAD-', ks) ELSE order_id END"
    order_topic = f"CASE WHEN r = 5 THEN {_lit(C.TOPIC_PAYMENTS)} ELSE {_lit(C.TOPIC_ORDERS)} END"

    pay_type = f"CASE WHEN failed THEN {_lit(C.PAYMENT_FAILED)} ELSE {_lit(C.PAYMENT_AUTHORIZED)} END"
    customer = """concat(',"customer_id":"', customer_id, '"')"""

    def payment_json(prefix: str, id_suffix: str, seconds: str, kind: str = pay_type,
                     failed: str = "failed", customer: str = customer) -> str:
        return _doc(
            *envelope(prefix, kind, _iso(seconds), "'1'", customer),
            _lit('{"payment_id":"'), "payment_id", _lit(id_suffix), _lit('","amount":'), "price",
            f"""CASE WHEN r = 7 THEN '' ELSE {_lit(',"currency":"' + CURRENCY + '"')} END""",
            f"""CASE WHEN {failed} AND r <> 9 THEN {_lit(',"reason":"' + PAYMENT_FAILED_REASON + '"')} ELSE '' END""",
            _lit("}}"))

    inv_type = f"CASE WHEN rejected THEN {_lit(C.INVENTORY_REJECTED)} ELSE {_lit(C.INVENTORY_RESERVED)} END"

    def inventory_json(prefix: str, seconds: str, sku: str) -> str:
        return _doc(
            *envelope(prefix, inv_type, _iso(seconds), "'1'", customer),
            _lit('{"sku":"SKU-'), f"lpad(cast({sku} AS string), 3, '0')", _lit('","quantity":'),
            """CASE WHEN r = 8 THEN '0' WHEN r = 11 THEN '"1"' ELSE '1' END""",
            f"""CASE WHEN rejected AND r <> 10 THEN {_lit(',"reason":"' + INVENTORY_REJECTED_REASON + '"')} ELSE '' END""",
            _lit("}}"))

    other_customer = """concat(',"customer_id":"', CASE WHEN k % 2 = 1 THEN 'ALT-' ELSE '' END, customer_id, '"')"""

    def record(present: str, key: str, topic: str, slot: int, raw: str) -> str:
        return (f"CASE WHEN {present} THEN named_struct('kafka_key', {key}, 'topic', {topic}, "
                f"'partition', cast(k % 3 AS int), 'offset', cast(k * {OFFSET_STRIDE} + {slot} AS bigint), "
                f"'raw_json', {raw}) END")

    records = ", ".join([
        record("true", order_key, order_topic, SLOT_ORDER, order_json),
        record(f"k % {DUPLICATE_MODULUS} = 0", order_key, order_topic, SLOT_ORDER_COPY, order_json),
        record("true", "order_id", _lit(C.TOPIC_PAYMENTS), SLOT_PAYMENT,
               payment_json("P-", "", "t0 + pay_gap")),
        record(f"k % {SECOND_PAYMENT_MODULUS} = 5", "order_id", _lit(C.TOPIC_PAYMENTS), SLOT_PAYMENT_2,
               payment_json("P2-", "-B", "t0 + pay_gap + 1")),
        record("NOT failed AND inv_present", "order_id", _lit(C.TOPIC_INVENTORY), SLOT_INVENTORY,
               inventory_json("I-", "t0 + pay_gap + inv_gap", "k % 100")),
        record(f"k % {RESENT_MODULUS} = 3", "order_id", _lit(C.TOPIC_PAYMENTS), SLOT_RESENT,
               payment_json("PR-", "", "t0 + pay_gap + 1", customer=other_customer)),
        record(f"failed AND k % {RECOVERY_MODULUS} = 4", "order_id", _lit(C.TOPIC_PAYMENTS), SLOT_RECOVERY,
               payment_json("PA-", "-C", "t0 + pay_gap + 60", _lit(C.PAYMENT_AUTHORIZED), "false")),
        record(f"failed AND k % {RECOVERY_MODULUS} = 4", "order_id", _lit(C.TOPIC_INVENTORY),
               SLOT_RECOVERY_INVENTORY, inventory_json("IA-", "t0 + pay_gap + 62", "k % 100")),
        record(f"NOT failed AND inv_present AND k % {SECOND_SKU_MODULUS} = 6", "order_id",
               _lit(C.TOPIC_INVENTORY), SLOT_SECOND_SKU,
               inventory_json("I2-", "t0 + pay_gap + inv_gap + 1", "(k + 1) % 100")),
    ])
    return base.selectExpr(f"inline(filter(array({records}), e -> e IS NOT NULL))")
