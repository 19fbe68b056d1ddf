"""The native state id equals SHA-256 of the canonical sorted-key JSON, for amounts of any size."""

import hashlib
import json

from orderflow.operators.states import STATE_ID_FIELDS, distinct_states, history_rows, upsert_view, with_state_id

ROWS = [
    ("ORD-1", "CUS-1", 150.0, "2026-10-09 01:52:11", "payment_authorized", "inventory_reserved", "COMPLETED"),
    ("ORD-2", "CUS-2", 85.5, "2026-10-09 01:52:21", "payment_failed", None, "PAYMENT_FAILED"),
    ("ORD-3", "CUS-é", 0.001, "2026-10-09 01:52:31", "payment_authorized", "inventory_rejected", "INVENTORY_REJECTED"),
    ("ORD-4", "CUS-4", 9999999.99, "2026-10-09 01:52:41", "payment_authorized", "inventory_reserved", "COMPLETED"),
    *[(f"ORD-1{i}", "C", amount, "2026-10-09 01:52:51", "payment_authorized", "inventory_reserved", "COMPLETED")
      for i, amount in enumerate([1e7, 1.25e7, 12500000.5, 123456789012345.67, 1e15, 9007199254740993.0, 1e16, 1.5e16,
                                  1e22, 1e100, 0.0005, 0.00012345, 0.0001, 0.00001, 1.5e-7, 0.0, -0.0, -2.5e8, -0.0005,
                                  1e-100])],
    *[(f"ORD-2{i}", text, 1.0, "2026-10-09 01:52:51", "payment_authorized", None, "UNKNOWN")
      for i, text in enumerate(["".join(map(chr, range(1, 32))), "\x1f\x1f\x0b", "\\u001F", "\\\x1a\\\\\x0e", "\x7f\u2028/",
                                '"\x1c"', "\\\\u000B\x0fA"])],
    ("ORD-5", "CUS-5", None, "2026-10-09 01:52:51", "payment_authorized", None, "UNKNOWN"),
]
SCHEMA = ("order_id string, customer_id string, order_amount double, order_time string, "
          "payment_status string, inventory_status string, order_status string")


def _py_id(row):
    fields = dict(zip(["order_id", "customer_id", "order_amount", "order_time", "payment_status",
                       "inventory_status", "order_status"], row))
    canonical = json.dumps(fields, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    return hashlib.sha256(canonical.encode("utf-8")).hexdigest()


def test_matches_hashlib(spark):
    df = with_state_id(spark.createDataFrame(ROWS, SCHEMA))
    got = {r.order_id: r.state_id for r in df.collect()}
    assert got == {row[0]: _py_id(row) for row in ROWS}


def test_sorted_fields():
    assert STATE_ID_FIELDS == sorted(STATE_ID_FIELDS)


def test_deterministic_outside_shared_range(spark):
    rows = [("ORD-9", "C", 1.0e8, "t", "payment_authorized", "inventory_reserved", "COMPLETED")]
    a = with_state_id(spark.createDataFrame(rows, SCHEMA)).first().state_id
    b = with_state_id(spark.createDataFrame(rows, SCHEMA)).first().state_id
    assert a == b and len(a) == 64


def test_distinct_states_are_the_upserted_ones(spark):
    times = ["2026-10-09 01:53:00", "2026-10-09 01:53:00.5", None]
    rows = [(*row, times[(i + k) % 3]) for i, row in enumerate([*ROWS, *ROWS[-3:], (None,) * 7]) for k in range(2)]
    states = spark.createDataFrame(rows, SCHEMA + ", decided_at string")
    want, got = upsert_view(history_rows(states)), history_rows(distinct_states(states))
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_plain_amounts_are_told_by_their_text_alone(spark):
    plan = with_state_id(spark.createDataFrame(ROWS, SCHEMA))._jdf.queryExecution().analyzed().toString()
    assert "(instr(cast(order_amount" in plan  # no pattern runs on an amount without an exponent
