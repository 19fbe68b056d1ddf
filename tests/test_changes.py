"""Orders by status from deltas, against the batch current state: changes, disorder, restart, replay."""

import json
import random
import time

from orderflow.operators import metrics as me
from orderflow.operators import states as st
from orderflow.sources import topics as tp
from orderflow.streaming import changes, jobs


def _states(seed, orders):
    """State rows of orders that change once or twice, in the order of their decisions, some twice."""
    draw, rows = random.Random(seed), []
    for k in range(orders):
        for n in range(draw.choice([1, 1, 2, 3])):
            paid = draw.random() < 0.5
            stocked = paid and draw.random() < 0.7
            rows.append({"order_id": f"ORD-{k}", "customer_id": "C", "order_amount": 1.0 + n,
                         "order_time": f"2026-10-09 01:{k % 60:02d}:00",
                         "payment_status": "payment_authorized" if paid else "payment_failed",
                         "order_status": "COMPLETED" if stocked else "INVENTORY_REJECTED" if paid else "PAYMENT_FAILED",
                         "decided_at": f"2026-10-09 {1 + (k % 60 + 5 * n) // 60:02d}:{(k % 60 + 5 * n) % 60:02d}:{draw.randrange(60):02d}"})
    rows += draw.sample(rows, len(rows) // 5)
    return sorted(rows, key=lambda r: r["decided_at"])


def _write(spark, path, rows):
    spark.createDataFrame([(r["order_id"], json.dumps(r)) for r in rows], "key string, value string").coalesce(1).write.parquet(path)
    time.sleep(0.05)


def test_deltas_add_up_to_the_current_state(spark, tmp_root):
    rows = _states(5, 180)
    parts = [rows[len(rows) * k // 6:len(rows) * (k + 1) // 6] for k in range(6)]
    for part in parts:
        random.Random(6).shuffle(part)

    def run():
        return jobs.run_to_end(changes.run_order_changes(
            tp.key_value_files(spark, f"{tmp_root}/src/*", max_files_per_trigger=1), f"{tmp_root}/changes", f"{tmp_root}/ck"))

    def compare():
        records = tp.key_value_files(spark, f"{tmp_root}/src/*", streaming=False)
        history = st.upsert_view(st.history_rows(st.parse_states(records).drop("order_time_parsed")))
        current = st.current_state(history)
        want = {r.order_status: r["count"] for r in current.groupBy("order_status").count().collect()}
        assert {r.order_status: r.order_count for r in changes.orders_by_status(spark, f"{tmp_root}/changes").collect()} == want
        by_order = changes.completion_by_order(spark, f"{tmp_root}/changes").first()
        assert by_order == me.completion_rate(current).first() and by_order.final_orders == sum(want.values())
        return history, by_order

    for k in range(4):
        _write(spark, f"{tmp_root}/src/b{k}", parts[k])
    query = run()
    compare()
    for k in (4, 5):  # a new query goes on from the checkpoint
        _write(spark, f"{tmp_root}/src/b{k}", parts[k])
    query = run()
    history, by_order = compare()
    # the other reading: state rows, of which some orders have several
    assert me.completion_rate(history).first().final_orders > by_order.final_orders == 180
    left = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert left < 180  # orders whose windows are over are forgotten


def test_a_batch_stored_again_counts_once(spark, tmp_root):
    store = changes.store_changes(f"{tmp_root}/changes")
    batch = spark.createDataFrame([("a", "COMPLETED", 1), ("b", "PAYMENT_FAILED", 1)], changes.DELTAS)
    later = spark.createDataFrame([("b", "COMPLETED", 1), ("b", "PAYMENT_FAILED", -1)], changes.DELTAS)
    for rows, n in ((batch, 0), (batch, 0), (later, 1), (later, 1)):
        store(rows, n, "q")
    assert [tuple(r) for r in changes.orders_by_status(spark, f"{tmp_root}/changes").collect()] == [("COMPLETED", 2)]


def test_the_orders_of_a_slot_share_a_state_row(spark, tmp_root):
    rows = _states(7, 120)
    for k in range(3):
        _write(spark, f"{tmp_root}/src/b{k}", rows[len(rows) * k // 3:len(rows) * (k + 1) // 3])
    source = tp.key_value_files(spark, f"{tmp_root}/src/*", max_files_per_trigger=1)
    states = st.history_rows(st.parse_states(source).drop("order_time_parsed"))
    query = jobs.run_to_end(jobs._start(changes.status_changes(states, slots=3), f"{tmp_root}/ck",
                                        changes.store_changes(f"{tmp_root}/changes"), mode="update"))
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) == 3  # of 120 orders
    records = tp.key_value_files(spark, f"{tmp_root}/src/*", streaming=False)
    current = st.current_state(st.history_rows(st.parse_states(records).drop("order_time_parsed")))
    assert ({r.order_status: r.order_count for r in changes.orders_by_status(spark, f"{tmp_root}/changes").collect()}
            == {r.order_status: r["count"] for r in current.groupBy("order_status").count().collect()})
