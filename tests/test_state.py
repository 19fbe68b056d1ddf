"""Join state read back from the checkpoint: it goes when the watermark passes, also while a domain
is quiet, with the bucket explode on and off; no row is lost by that."""

from datetime import datetime, timedelta

import pytest

from orderflow.operators import states as st
from orderflow.sources import topics as tp
from orderflow.streaming import jobs, state

from test_streaming import _event, _kv_file, _pay

START = datetime(2026, 10, 9, 1, 0, 0)


def _stock(event_id, t, order):
    return {**_event(event_id, t, order), "event_type": "inventory_reserved", "payload": {"sku": "S", "quantity": 1}}


def _run(spark, root, **kw):
    return jobs.run_to_end(jobs.run_business(tp.key_value_files(spark, f"{root}/src/*", max_files_per_trigger=1),
                                             f"{root}/states", f"{root}/ck", **kw))


def _held(spark, root):
    """{(join, side): rows}; the first join of the plan is order -> payment."""
    rows = state.counts(spark, f"{root}/ck").collect()
    joins = sorted({r.operator_id for r in rows}, reverse=True)
    assert all(r.operator == state.JOIN for r in rows) and len(joins) == 2
    totals = {}
    for r in rows:
        totals[r.operator_id, r.side] = r.rows
    return totals


def _orders(hour, n=20):
    return [_event(f"O{hour}-{k}", START + timedelta(hours=hour, seconds=k), f"ORD-{hour}-{k}") for k in range(n)]


@pytest.mark.parametrize("bucketed", [True, False])
def test_state_goes_while_payments_are_quiet_and_nothing_is_lost(spark, tmp_root, bucketed):
    # hour 0: 20 orders, 12 authorized payments that wait for inventory; then hours of orders alone
    _kv_file(spark, f"{tmp_root}/src", "b0", _orders(0) + [
        _pay(f"P{k}", START + timedelta(seconds=60 + k), f"ORD-0-{k}") for k in range(12)])
    _run(spark, tmp_root, bucketed=bucketed)
    before = _held(spark, tmp_root)
    assert sum(before.values()) == 20 + 12 * (2 if bucketed else 1) + 12  # orders, payments (a row a bucket), matches
    for hour in (1, 2, 3):
        _kv_file(spark, f"{tmp_root}/src", f"b{hour}", _orders(hour))
    _run(spark, tmp_root, bucketed=bucketed)
    after = _held(spark, tmp_root)
    assert sorted(after.values()) == [0, 0, 0, 20]  # the last hour's orders, no payment, no match, no result
    # the quiet domain speaks again, in time: every one of its rows finds its order
    _kv_file(spark, f"{tmp_root}/src", "b4", [_pay(f"Q{k}", START + timedelta(hours=3, minutes=5), f"ORD-3-{k}")
                                             for k in range(20)])
    _kv_file(spark, f"{tmp_root}/src", "b5", [_stock(f"I{k}", START + timedelta(hours=3, minutes=9), f"ORD-3-{k}")
                                             for k in range(20)])
    _run(spark, tmp_root, bucketed=bucketed)
    states = st.parse_states(tp.key_value_log(spark, f"{tmp_root}/states", streaming=False))
    assert sorted(r.order_id for r in states.filter("order_status = 'COMPLETED'").collect()) == sorted(
        f"ORD-3-{k}" for k in range(20))


def test_a_watermark_a_domain_holds_the_state_of_the_others(spark, tmp_root):
    _kv_file(spark, f"{tmp_root}/src", "b0", _orders(0) + [_pay("P", START + timedelta(seconds=60), "ORD-0-1")])
    for hour in (1, 2, 3):
        _kv_file(spark, f"{tmp_root}/src", f"b{hour}", _orders(hour))
    _run(spark, tmp_root, shared=False)
    assert max(_held(spark, tmp_root).values()) == 80  # the min policy: no payments, nothing goes


def test_pending_stream_expires_without_any_payment(spark, tmp_root):
    for hour in (0, 1, 2):
        _kv_file(spark, f"{tmp_root}/src", f"b{hour}", _orders(hour, 3))
    events = jobs._events(tp.key_value_files(spark, f"{tmp_root}/src/*", max_files_per_trigger=1))
    q = (jobs.pending_stream(events).writeStream.format("memory").queryName("quiet_test")
         .option("checkpointLocation", f"{tmp_root}/ck").trigger(availableNow=True).start())
    jobs.run_to_end(q)
    assert spark.table("quiet_test").count() == 6
    assert {name for _, name in state.operators(spark, f"{tmp_root}/ck")} == {state.JOIN}
