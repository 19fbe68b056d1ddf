"""The stream's expired orders against the batch report, through a restart; state that shrinks."""

import json
import random
import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from orderflow.operators import audit as au
from orderflow.operators import correlate as corr
from orderflow.operators.dedup import with_event_time
from orderflow.plans.flow import EventFlow
from orderflow.sources import topics as tp
from orderflow.streaming import jobs, pending

from conftest import SF_SMALL

MINUTE = 60_000_000


def _event(n, kind, at, order):
    return {"event_id": f"E{n}", "event_type": kind, "event_time": at.strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z",
            "schema_version": 1, "order_id": order, "customer_id": "C", "payload": {"payment_id": f"P{n}", "sku": "S"}}


def _log(seed, orders):
    """Orders with no, one or two payments and inventory results before, inside and after the windows."""
    draw, start, events = random.Random(seed), datetime(2026, 10, 9, 1, 0, 0), []

    def add(kind, at, order):
        events.append(_event(len(events), kind, at, order))

    for k in range(orders):
        at, order = start + timedelta(seconds=draw.randrange(6 * 3600)), f"ORD-{k}"
        add("order_created", at, order)
        for _ in range(draw.choice([0, 0, 1, 1, 2])):
            paid = at + timedelta(seconds=draw.choice([-5, 0, 60, 600, 900, 901, 1000]))
            add(draw.choice(["payment_authorized"] * 4 + ["payment_failed"]), paid, order)
            if draw.random() < 0.5:
                add("inventory_reserved", paid + timedelta(seconds=draw.choice([-30, 0, 300, 900, 901])), order)
    return sorted(events, key=lambda e: e["event_time"])


def _write(spark, path, events):
    rows = [(e["order_id"], json.dumps(e)) for e in events]
    spark.createDataFrame(rows, "key string, value string").coalesce(1).write.parquet(path)
    time.sleep(0.05)


def _batch(events):
    o, p, i = corr.split_domains(events)
    rows = au.pending_orders(o, p, i, events).filter("pending_status = 'EXPIRED'")
    return sorted((r.order_id, r.order_time, r.pending_reason) for r in rows.collect())


def _streamed(spark, path):
    rows = spark.read.schema(pending.EXPIRED).parquet(path)
    return sorted((r.order_id, r.order_time, r.pending_reason) for r in rows.collect())


def _run(spark, src, root):
    return jobs.run_to_end(pending.run_pending(tp.key_value_files(spark, f"{src}/*", max_files_per_trigger=1),
                                               f"{root}/expired", f"{root}/ck"))


def test_expired_orders_equal_batch_through_a_restart(spark, tmp_root):
    events = _log(1, 250)
    cut = [len(events) * k // 5 for k in range(6)]
    for k in range(3):
        _write(spark, f"{tmp_root}/src/b{k}", events[cut[k]:cut[k + 1]])
    _run(spark, f"{tmp_root}/src", tmp_root)
    first = _streamed(spark, f"{tmp_root}/expired")
    seen = with_event_time(jobs._events(tp.key_value_files(spark, f"{tmp_root}/src/*", streaming=False)))
    assert first == _batch(seen) and first
    for k in range(3, 5):  # a new query on the same checkpoint goes on with the waits that were open
        _write(spark, f"{tmp_root}/src/b{k}", events[cut[k]:cut[k + 1]])
    query = _run(spark, f"{tmp_root}/src", tmp_root)
    got = _streamed(spark, f"{tmp_root}/expired")
    seen = jobs._events(tp.key_value_files(spark, f"{tmp_root}/src/*", streaming=False))
    assert got == _batch(seen) and len(got) > len(first)
    assert {why for _, _, why in got} == {"AWAITING_PAYMENT", "AWAITING_INVENTORY"}
    assert len({order for order, _, _ in got}) == len(got)  # one emission an order
    # only waits that the watermark has not passed are left
    watermark = max(e["event_time"] for e in events)
    left = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    horizon = (datetime.strptime(watermark[:19], "%Y-%m-%dT%H:%M:%S") - timedelta(minutes=55)).strftime("%Y-%m-%dT%H:%M:%S")
    assert left <= 3 * sum(e["event_time"] >= horizon for e in events)


def test_expired_orders_of_the_derived_log_equal_batch(spark, tmp_root):
    flow = EventFlow(spark, SF_SMALL)
    unique = flow.unique.select("event_id", "event_type", "order_id", "customer_id", "event_timestamp", "payload")
    unique.write.parquet(f"{tmp_root}/unique")
    unique = spark.read.parquet(f"{tmp_root}/unique")
    (unique.repartitionByRange(6, "event_timestamp").sortWithinPartitions("event_timestamp")
     .select(F.col("order_id").alias("key"), F.to_json(F.struct(
         "event_id", "event_type", "order_id", "customer_id",
         F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("event_time"))).alias("value"))
     .write.parquet(f"{tmp_root}/src/all"))
    jobs.run_to_end(pending.run_pending(tp.key_value_files(spark, f"{tmp_root}/src"), f"{tmp_root}/expired", f"{tmp_root}/ck"))
    got = _streamed(spark, f"{tmp_root}/expired")
    assert got == _batch(unique) and len(got) > 10


def test_a_hot_order_id_is_dealt_over_its_time(spark, tmp_root):
    start = datetime(2026, 10, 9, 0, 0, 0)
    events = [_event(k, "order_created", start + timedelta(minutes=k), "HOT") for k in range(600)]
    events.append(_event(9000, "payment_failed", start + timedelta(minutes=121), "HOT"))  # in two buckets, seen once
    _write(spark, f"{tmp_root}/src/b0", sorted(events, key=lambda e: e["event_time"]))
    query = _run(spark, f"{tmp_root}/src", tmp_root)
    got = _streamed(spark, f"{tmp_root}/expired")
    resolved = range(106, 122)  # the payment lies within the window of these
    last = 599 - 10 - 15  # the watermark is past these orders' windows
    assert [r[1] for r in sorted(got, key=lambda r: r[1])] == [start + timedelta(minutes=k) for k in range(last)
                                                              if k not in resolved]
    assert query.recentProgress[0]["stateOperators"][0]["numRowsUpdated"] >= 5  # a state row a bucket


def test_the_waits_of_a_slot_share_a_state_row(spark, tmp_root):
    events = _log(3, 200)
    for k in range(3):
        _write(spark, f"{tmp_root}/src/b{k}", events[len(events) * k // 3:len(events) * (k + 1) // 3])
    source = tp.key_value_files(spark, f"{tmp_root}/src/*", max_files_per_trigger=1)
    query = jobs.run_to_end(jobs._start(pending.expired_orders(jobs._events(source), slots=3), f"{tmp_root}/ck",
                                        target=jobs._target(f"{tmp_root}/expired")))
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) == 3  # of 200 orders
    seen = jobs._events(tp.key_value_files(spark, f"{tmp_root}/src/*", streaming=False))
    assert _streamed(spark, f"{tmp_root}/expired") == _batch(seen)


def test_waits_of_one_group():
    hour = 60 * MINUTE
    # nothing known: look again when the window is over
    assert pending.expired([[hour], [], [], []], 15 * MINUTE, 0) == ([], [[hour], [], [], []], 75 * 60_000)
    # the deadline itself is not over yet, the next millisecond is
    assert pending.expired([[hour], [], [], []], 15 * MINUTE, 75 * 60_000)[0] == []
    assert pending.expired([[hour], [], [], []], 15 * MINUTE, 75 * 60_000 + 1) == ([(hour, "AWAITING_PAYMENT")], [[], [], [], []], None)
    # the last authorized payment moves the deadline
    waits = [[hour], [hour + MINUTE, hour + 9 * MINUTE], [], []]
    assert pending.expired(waits, 15 * MINUTE, 80 * 60_000)[2] == 84 * 60_000
    assert pending.expired(waits, 15 * MINUTE, 84 * 60_000 + 1)[0] == [(hour, "AWAITING_INVENTORY")]
    # a failed payment or an inventory result settles it
    assert pending.expired([[hour], [], [hour], []], 15 * MINUTE, 0)[:2] == ([], [[], [], [hour], []])
    assert pending.expired([[hour], [hour], [], [hour + 15 * MINUTE]], 15 * MINUTE, 200 * 60_000) == ([], [[], [], [], []], None)
