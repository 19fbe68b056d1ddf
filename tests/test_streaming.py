"""Streaming stages on file sources: batch equals stream, restart, dedup, late rows.

Batch results equal streaming results only when no row arrives behind the watermark; each
test that compares them feeds files in event-time order (or everything in one micro-batch).
"""

import json
import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from orderflow.operators import states as st
from orderflow.plans.flow import EventFlow
from orderflow.sources import topics as tp
from orderflow.streaming import jobs, sinks

from conftest import SF_SMALL


def _history_rows(df):
    return sorted(tuple(r) for r in df.select(
        "order_id", "state_id", "order_status", "inventory_status").collect())


def _write_sorted_log(spark, flow, src, pieces):
    """The derived topic log as ``pieces`` parquet files in event-time order."""
    log = flow.topic_rows.withColumn(
        "_t", F.try_to_timestamp(F.get_json_object("raw_json", "$.event_time")))
    bounds = log.agg(F.min("_t").alias("lo"), F.max("_t").alias("hi")).first()
    span = (bounds.hi - bounds.lo) / pieces
    for i in range(pieces):
        lo = bounds.lo + span * i
        part = log.filter((F.col("_t") >= lo) & (F.col("_t") < lo + span)) if i < pieces - 1 \
            else log.filter((F.col("_t") >= lo) | F.col("_t").isNull())
        part.drop("_t").coalesce(1).write.parquet(f"{src}/part_{i:03d}")
        time.sleep(0.05)


def test_pipeline_equals_batch_and_restart_is_quiet(spark, tmp_root):
    flow = EventFlow(spark, SF_SMALL)
    src = f"{tmp_root}/source"
    _write_sorted_log(spark, flow, src, 3)
    source = tp.file_topics(spark, f"{src}/*", max_files_per_trigger=1)
    paths = jobs.run_pipeline(spark, source, f"{tmp_root}/run")

    streamed = sinks.read_history(spark, paths.history)
    batch = st.upsert_view(flow.history)
    assert _history_rows(streamed) == _history_rows(batch)

    dlq = tp.key_value_log(spark, paths.routed, streaming=False, route="INVALID")
    assert dlq.count() == flow.classified.filter("validation_status = 'INVALID'").count()
    assert paths.observed["validation"]["total"] == flow.topic_rows.count()
    assert paths.observed["validation"]["invalid"] == dlq.count()
    assert paths.observed["states"]["unknown"] == 0
    codes = {json.loads(r.value)["error_reason"] for r in dlq.collect()}
    assert "INVALID_JSON" in codes and "INVALID_KAFKA_KEY" in codes

    # restart on the same checkpoints with no new input: no new output anywhere
    logs = (paths.routed, paths.unique, paths.states)
    before = [spark.read.parquet(p).count() for p in logs]
    jobs.run_pipeline(spark, tp.file_topics(spark, f"{src}/*", max_files_per_trigger=1),
                      f"{tmp_root}/run")
    assert before == [spark.read.parquet(p).count() for p in logs]
    assert _history_rows(sinks.read_history(spark, paths.history)) == _history_rows(batch)


def _kv_file(spark, root, name, events):
    rows = [(e["order_id"], json.dumps(e)) for e in events]
    spark.createDataFrame(rows, "key string, value string").coalesce(1).write.parquet(f"{root}/{name}")
    time.sleep(0.05)


def _event(event_id, t, order="ORD-1"):
    return {"event_id": event_id, "event_type": "order_created",
            "event_time": t.strftime("%Y-%m-%dT%H:%M:%S.000Z"), "schema_version": 1,
            "order_id": order, "customer_id": "C", "payload": {"total_amount": 1.0, "currency": "MAD"}}


def _run_dedup(spark, src, out, ckpt):
    return jobs.run_to_end(jobs.run_dedup(tp.key_value_files(spark, src, max_files_per_trigger=1),
                                          out, ckpt))


def test_dedup_three_in_two_out_and_restart(spark, tmp_root):
    src, out, ckpt = f"{tmp_root}/src", f"{tmp_root}/unique", f"{tmp_root}/ckpt"
    t = datetime(2026, 10, 9, 1, 0, 0)
    _kv_file(spark, src, "b1", [_event("A", t)])
    _kv_file(spark, src, "b2", [_event("A", t)])
    _kv_file(spark, src, "b3", [_event("B", t + timedelta(seconds=1))])
    _run_dedup(spark, src, out, ckpt)
    ids = sorted(r.key for r in tp.key_value_files(spark, out, streaming=False)
                 .select(F.get_json_object("value", "$.event_id").alias("key")).collect())
    assert ids == ["A", "B"]
    # restart: an old id is suppressed from the state in the checkpoint, a new one passes
    _kv_file(spark, src, "b4", [_event("A", t), _event("C", t + timedelta(seconds=2))])
    _run_dedup(spark, src, out, ckpt)
    ids = sorted(r.key for r in tp.key_value_files(spark, out, streaming=False)
                 .select(F.get_json_object("value", "$.event_id").alias("key")).collect())
    assert ids == ["A", "B", "C"]


def test_late_rows_lag_one_batch(spark, tmp_root):
    """batch 1 normal; batch 2 moves event time +2 h; batch 3's old rows are still accepted
    (the late filter uses the previous batch's watermark); batch 4's old rows are dropped."""
    src, out, ckpt = f"{tmp_root}/src", f"{tmp_root}/unique", f"{tmp_root}/ckpt"
    t = datetime(2026, 10, 9, 1, 0, 0)
    _kv_file(spark, src, "b1", [_event("E1", t)])
    _kv_file(spark, src, "b2", [_event("E2", t + timedelta(hours=2))])
    _kv_file(spark, src, "b3", [_event("E3", t + timedelta(minutes=1))])
    _kv_file(spark, src, "b4", [_event("E4", t + timedelta(minutes=2))])
    q = _run_dedup(spark, src, out, ckpt)
    ids = sorted(r.key for r in tp.key_value_files(spark, out, streaming=False)
                 .select(F.get_json_object("value", "$.event_id").alias("key")).collect())
    assert ids == ["E1", "E2", "E3"]
    assert jobs.dropped_by_watermark(q) == 1
    assert jobs.observed_event_time(q).get("watermark") is not None


def test_streaming_volume_and_completion(spark, tmp_root):
    src = f"{tmp_root}/src"
    t = datetime(2026, 10, 9, 1, 52, 11)
    _kv_file(spark, src, "b1", [_event("O1", t, "ORD-1"), _event("O2", t + timedelta(seconds=10), "ORD-2"),
                                _event("O3", t + timedelta(seconds=20), "ORD-3")])
    volume = jobs.volume_stream(tp.key_value_files(spark, src))
    q = (volume.writeStream.outputMode("update").format("memory").queryName("vol_test")
         .option("checkpointLocation", f"{tmp_root}/ck_vol").trigger(availableNow=True).start())
    jobs.run_to_end(q)
    rows = spark.table("vol_test").collect()
    assert sum(r.order_count for r in rows) == 3

    states = spark.createDataFrame(
        [("ORD-1", "COMPLETED"), ("ORD-2", "PAYMENT_FAILED"), ("ORD-3", "INVENTORY_REJECTED")],
        "order_id string, order_status string")
    states.coalesce(1).write.parquet(f"{tmp_root}/states")
    stream = spark.readStream.schema("order_id string, order_status string").parquet(f"{tmp_root}/states")
    q = (jobs.completion_stream(stream).writeStream.outputMode("update").format("memory")
         .queryName("rate_test").option("checkpointLocation", f"{tmp_root}/ck_rate")
         .trigger(availableNow=True).start())
    jobs.run_to_end(q)
    assert spark.table("rate_test").first().completion_rate_pct == 33.33


def _pay(event_id, t, order="ORD-1", etype="payment_authorized"):
    return {"event_id": event_id, "event_type": etype,
            "event_time": t.strftime("%Y-%m-%dT%H:%M:%S.000Z"), "schema_version": 1,
            "order_id": order, "customer_id": "C",
            "payload": {"payment_id": "PAY-" + event_id, "amount": 1.0, "currency": "MAD",
                        "reason": "payment_declined"}}


def test_out_of_order_payment_still_joins_and_states_are_observed(spark, tmp_root):
    """The payment's file arrives before its order's file (both on time)."""
    src, out = f"{tmp_root}/src", f"{tmp_root}/states"
    t = datetime(2026, 10, 9, 1, 0, 0)
    _kv_file(spark, src, "b1", [_pay("P1", t + timedelta(seconds=2), "ORD-1", "payment_failed")])
    _kv_file(spark, src, "b2", [_event("O1", t, "ORD-1")])
    q = jobs.run_to_end(jobs.run_business(tp.key_value_files(spark, src, max_files_per_trigger=1),
                                          out, f"{tmp_root}/ck"))
    states = st.parse_states(tp.key_value_files(spark, out, streaming=False)).collect()
    assert [(r.order_id, r.order_status) for r in states] == [("ORD-1", "PAYMENT_FAILED")]
    assert set(jobs.observed(q, "states")) >= {"states", "unknown"}


def test_streaming_pending_orders_expire(spark, tmp_root):
    src = f"{tmp_root}/src"
    t = datetime(2026, 10, 9, 1, 0, 0)
    _kv_file(spark, src, "b1", [_event("O1", t, "ORD-1"), _event("O2", t, "ORD-2"),
                                _pay("P2", t + timedelta(seconds=5), "ORD-2")])
    _kv_file(spark, src, "b2", [_event("O3", t + timedelta(hours=1), "ORD-3")])
    _kv_file(spark, src, "b3", [_event("O4", t + timedelta(hours=2), "ORD-4")])
    events = (tp.key_value_files(spark, src, max_files_per_trigger=1)
              .select(F.from_json("value", "event_id string, event_type string, event_time string, "
                                  "order_id string").alias("e")).select("e.*"))
    from orderflow.operators.dedup import with_event_time
    events = with_event_time(events)
    q = (jobs.pending_stream(events).writeStream.outputMode("append").format("memory")
         .queryName("pending_test").option("checkpointLocation", f"{tmp_root}/ck")
         .trigger(availableNow=True).start())
    jobs.run_to_end(q)
    expired = sorted(r.order_id for r in spark.table("pending_test").collect())
    assert expired == ["ORD-1", "ORD-3"]


def test_kafka_option_map():
    opts = tp.kafka_options("broker:9092", ["orders", "payments"], max_offsets_per_trigger=50)
    assert opts == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "orders,payments",
                    "startingOffsets": "earliest", "maxOffsetsPerTrigger": "50"}


def test_history_upsert_is_replay_safe(spark, tmp_root):
    rows = [("ORD-1", "C", 10.0, "2026-10-09 01:00:00", "payment_failed", None, "PAYMENT_FAILED"),
            ("ORD-2", "C", 11.0, "2026-10-09 01:00:05", "payment_authorized", "inventory_reserved", "COMPLETED")]
    batch = spark.createDataFrame(rows, "order_id string, customer_id string, order_amount double, "
                                        "order_time string, payment_status string, "
                                        "inventory_status string, order_status string")
    sink = sinks.upsert_history(f"{tmp_root}/hist")
    sink(batch, 0)
    sink(batch, 0)          # replay of the same micro-batch
    sink(batch.limit(1), 1)  # a later batch re-delivering one state
    hist = sinks.read_history(spark, f"{tmp_root}/hist")
    assert sorted(r.order_id for r in hist.collect()) == ["ORD-1", "ORD-2"]


def _fail_pay(order):
    t = datetime(2026, 10, 9, 1, 0, 0)
    return [_event(f"O-{order}", t, order), _pay(f"P-{order}", t + timedelta(seconds=2), order, "payment_failed")]


def test_two_checkpoints_on_one_history_keep_both_orders(spark, tmp_root):
    for n, order in enumerate(("ORD-1", "ORD-2")):
        _kv_file(spark, f"{tmp_root}/src{n}", "b", _fail_pay(order))
        jobs.run_to_end(jobs.run_business(tp.key_value_files(spark, f"{tmp_root}/src{n}"), f"{tmp_root}/states{n}",
                                          f"{tmp_root}/ckb{n}"))
        jobs.run_to_end(jobs.run_history(tp.key_value_log(spark, f"{tmp_root}/states{n}"), f"{tmp_root}/hist",
                                         f"{tmp_root}/ckh{n}"))
    assert sorted(r.order_id for r in sinks.read_history(spark, f"{tmp_root}/hist").collect()) == ["ORD-1", "ORD-2"]


def test_replayed_batch_counts_once_downstream(spark, tmp_root):
    """The last commit of the dedup stage is taken back, so its batch runs again."""
    src, unique, states = f"{tmp_root}/src", f"{tmp_root}/unique", f"{tmp_root}/states"
    _kv_file(spark, src, "b", _fail_pay("ORD-1"))
    _run_dedup(spark, src, unique, f"{tmp_root}/ckd")

    def business():
        jobs.run_to_end(jobs.run_business(tp.key_value_log(spark, unique), states, f"{tmp_root}/ckb"))
        return tp.key_value_log(spark, states, streaming=False).count()

    assert business() == 1
    commits = f"{tmp_root}/ckd/commits"
    last = max(int(f) for f in os.listdir(commits) if f.isdigit())
    os.rename(f"{commits}/{last}", f"{tmp_root}/commit-taken-back")
    if os.path.exists(f"{commits}/.{last}.crc"):
        os.rename(f"{commits}/.{last}.crc", f"{tmp_root}/crc-taken-back")
    _run_dedup(spark, src, unique, f"{tmp_root}/ckd")
    assert business() == 1


def test_totals_cover_more_batches_than_the_progress_buffer(spark, tmp_root):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        for b in range(8):
            spark.createDataFrame([(f"K{b}", "orders", 0, b, "broken")], "kafka_key string, topic string, "
                                  "partition int, offset long, raw_json string").coalesce(1) \
                .write.parquet(f"{tmp_root}/src/b{b}")
        q = jobs.run_to_end(jobs.run_validation(
            tp.file_topics(spark, f"{tmp_root}/src/*", max_files_per_trigger=1), f"{tmp_root}/log", f"{tmp_root}/ck"))
        assert len(q.recentProgress) <= 3
        assert jobs.observed_total(q, "validation") == {"valid": 0, "invalid": 8, "total": 8}
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_failing_query_raises(spark, tmp_root):
    _kv_file(spark, f"{tmp_root}/src", "b", _fail_pay("ORD-1"))
    rows = tp.key_value_files(spark, f"{tmp_root}/src").select("key", F.raise_error(F.lit("broken row")).alias("value"))
    q = jobs._start(rows.select("key", F.col("value").cast("string").alias("value")), f"{tmp_root}/ck",
                    target=jobs.log_target(f"{tmp_root}/out"))
    with pytest.raises(StreamingQueryException):
        jobs.run_to_end(q)


def test_durable_failure_rate_and_completion_after_a_restart(spark, tmp_root):
    from orderflow.operators import metrics as me
    t = datetime(2026, 10, 9, 1, 0, 0)
    types = ["payment_failed", "payment_authorized", "payment_authorized", "payment_authorized"]
    states = [("ORD-1", "COMPLETED"), ("ORD-2", "PAYMENT_FAILED"), ("ORD-3", "COMPLETED")]
    for part in range(2):
        _kv_file(spark, f"{tmp_root}/src", f"b{part}", [
            _pay(f"P{part}{i}", t + timedelta(minutes=part, seconds=i), f"ORD-{part}{i}", k)
            for i, k in enumerate(types)])
        rows = [(o, json.dumps({"order_id": o, "order_time": "2026-10-09 01:00:00", "order_status": s}))
                for o, s in states[2 * part:2 * part + 2]]
        spark.createDataFrame(rows, "key string, value string").coalesce(1).write.parquet(f"{tmp_root}/st/b{part}")
        jobs.run_to_end(jobs.run_failure_rate(tp.key_value_files(spark, f"{tmp_root}/src"), f"{tmp_root}/m",
                                              f"{tmp_root}/ck1"))
        jobs.run_to_end(jobs.run_completion(tp.key_value_files(spark, f"{tmp_root}/st"), f"{tmp_root}/m",
                                            f"{tmp_root}/ck2"))
        jobs.run_to_end(jobs.run_orders_per_minute(tp.key_value_files(spark, f"{tmp_root}/src"), f"{tmp_root}/m",
                                                   f"{tmp_root}/ck3"))
    got = {r.metric_name: r.metric_value for r in sinks.read_metrics(spark, f"{tmp_root}/m").collect()}
    assert got == {"payment_failure_rate_5m": 25.0, "completion_rate": 66.67}
    batch = spark.createDataFrame([(s,) for _, s in states], "order_status string")
    assert me.completion_rate(batch).first().completion_rate_pct == 66.67


def test_business_dedup_stream_keeps_two_skus_and_drops_a_fact_sent_again(spark, tmp_root):
    t = datetime(2026, 10, 9, 1, 0, 0)
    events = []
    for event_id, sku in (("I1", "SKU-1"), ("I2", "SKU-2"), ("I3", "SKU-1")):
        e = _event(event_id, t)
        events.append({**e, "event_type": "inventory_reserved", "payload": {"sku": sku, "quantity": 1}})
    _kv_file(spark, f"{tmp_root}/src", "b", events)
    kept = jobs.business_dedup_stream(jobs._events(tp.key_value_files(spark, f"{tmp_root}/src"))).select("sku")
    q = (kept.writeStream.format("memory").queryName("sku_test").option("checkpointLocation", f"{tmp_root}/ck")
         .trigger(availableNow=True).start())
    jobs.run_to_end(q)
    assert sorted(r.sku for r in spark.table("sku_test").collect()) == ["SKU-1", "SKU-2"]


def test_kafka_targets_and_the_adapter_for_later_stages(spark):
    assert jobs.kafka_target("broker:9092", "unique-events") == {
        "format": "kafka", "options": {"kafka.bootstrap.servers": "broker:9092", "topic": "unique-events"},
        "partition_by": None}
    rows = spark.createDataFrame([("K", "orders", 0, 1, "{}")],
                                 "kafka_key string, topic string, partition int, offset long, raw_json string")
    assert tp.key_value_topic(rows).first().asDict() == {"key": "K", "value": "{}"}


def test_durable_volume_metrics_equal_batch(spark, tmp_root):
    """Volume windows updated over several micro-batches; the latest value per window equals
    the batch aggregate (no late rows: files in event-time order)."""
    from orderflow.operators import metrics as me
    src = f"{tmp_root}/src"
    t = datetime(2026, 10, 9, 1, 0, 0)
    batches = [[_event(f"O{b}{j}", t + timedelta(minutes=2 * b, seconds=20 * j), f"ORD-{b}{j}")
                for j in range(3)] for b in range(4)]
    for b, events in enumerate(batches):
        _kv_file(spark, src, f"b{b}", events)
    q = jobs.run_volume(tp.key_value_files(spark, src, max_files_per_trigger=1),
                        f"{tmp_root}/metrics", f"{tmp_root}/ck")
    jobs.run_to_end(q)
    got = {(r.window_start, r.metric_value) for r in sinks.read_metrics(spark, f"{tmp_root}/metrics").collect()}
    rows = [(e["event_time"],) for evs in batches for e in evs]
    df = spark.createDataFrame(rows, "event_time string").selectExpr(
        "try_to_timestamp(event_time) AS event_timestamp")
    want = {(r.window_start, float(r.order_count)) for r in me.order_volume(df).collect()}
    assert got == want and len(got) >= 2


def test_periodic_trigger(spark, tmp_root):
    src, out = f"{tmp_root}/src", f"{tmp_root}/unique"
    t = datetime(2026, 10, 9, 1, 0, 0)
    _kv_file(spark, src, "b1", [_event("P1", t), _event("P1", t), _event("P2", t)])
    q = jobs.run_dedup(tp.key_value_files(spark, src), out, f"{tmp_root}/ck",
                       trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert tp.key_value_files(spark, out, streaming=False).count() == 2


def test_decode_binary_kafka_records(spark):
    rows = [(bytearray(b"ORD-1"), bytearray(b'{"event_id":"E"}'), "orders", 2, 7)]
    raw = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long")
    got = tp.decode_kafka(raw).first()
    assert (got.kafka_key, got.raw_json, got.topic, got.partition, got.offset) == \
        ("ORD-1", '{"event_id":"E"}', "orders", 2, 7)


def test_table_topics(spark):
    rows = [("ORD-1", "orders", 0, 1, "{}")]
    spark.createDataFrame(rows, "kafka_key string, topic string, partition int, offset long, raw_json string") \
        .createOrReplaceTempView("topic_rows_fixture")
    assert tp.table_topics(spark, "topic_rows_fixture").columns == \
        ["kafka_key", "topic", "partition", "offset", "raw_json"]


def test_two_level_dedup_of_a_hot_id(spark, tmp_root):
    """Many copies of one id spread over several input files in one micro-batch, plus a copy
    in a later batch: exactly one row out, as with the single-level dedup."""
    src, out = f"{tmp_root}/src", f"{tmp_root}/unique"
    t = datetime(2026, 10, 9, 1, 0, 0)
    for i in range(4):
        _kv_file(spark, src, f"a{i}", [_event("HOT", t)] * 50 + [_event(f"N{i}", t)])
    q = jobs.run_to_end(jobs.run_dedup(tp.key_value_files(spark, src), out, f"{tmp_root}/ck",
                                       spread=4))
    _kv_file(spark, src, "late_copy", [_event("HOT", t), _event("N9", t)])
    jobs.run_to_end(jobs.run_dedup(tp.key_value_files(spark, src), out, f"{tmp_root}/ck", spread=4))
    ids = sorted(r.key for r in tp.key_value_files(spark, out, streaming=False)
                 .select(F.get_json_object("value", "$.event_id").alias("key")).collect())
    assert ids == ["HOT", "N0", "N1", "N2", "N3", "N9"]
    assert len(q.lastProgress["stateOperators"]) == 2
