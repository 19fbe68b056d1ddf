"""Four live queries: one killed and one failing stage resume, a clean drain, a stage given up."""

import time

import pytest
from pyspark.sql import functions as F

from orderflow.operators import states as st
from orderflow.plans.flow import EventFlow
from orderflow.sources import topics as tp
from orderflow.streaming import jobs, sinks
from orderflow.streaming.live import LivePipeline, StageFailed

from conftest import SF_SMALL
from test_streaming import _fail_pay, _history_rows, _write_sorted_log

SOON = {"processingTime": "200 milliseconds"}


def _until(pipeline, true, seconds=120):
    end = time.monotonic() + seconds
    while not true():
        assert time.monotonic() < end
        pipeline.run(0.3, poll=0.1)


def test_live_stages_survive_a_kill_and_a_failure_and_equal_batch(spark, tmp_root):
    flow = EventFlow(spark, SF_SMALL)
    _write_sorted_log(spark, flow, f"{tmp_root}/all", 3)
    spark.read.parquet(f"{tmp_root}/all/part_000").write.parquet(f"{tmp_root}/source/part_000")
    source = tp.file_topics(spark, f"{tmp_root}/source/*")
    live = LivePipeline(spark, source, f"{tmp_root}/run", SOON, dedup_spread=None)
    # the first start of the business stage reads rows that fail
    business, broken = live.stage("business"), []

    def begin():
        if not broken:
            broken.append(1)
            rows = tp.key_value_log(spark, live.paths.unique).withColumn(
                "value", F.raise_error(F.lit("broken row")).cast("string"))
            return jobs.run_business(rows, live.paths.states, live.paths.checkpoint("business"), trigger=SOON)
        return begun()

    begun, business.begin = business.begin, begin
    live.start()
    assert all(s.query.isActive for s in live.stages)
    _until(live, lambda: business.restarts >= 1)
    assert "broken row" in business.history[0]
    killed = live.stage("deduplication")
    killed.query.stop()
    spark.read.parquet(f"{tmp_root}/all/part_001").write.parquet(f"{tmp_root}/source/part_001")
    _until(live, lambda: killed.restarts == 1)
    assert live.stage("validation").restarts == live.stage("history").restarts == 0
    spark.read.parquet(f"{tmp_root}/all/part_002").write.parquet(f"{tmp_root}/source/part_002")
    live.drain()
    assert not any(s.query.isActive for s in live.stages)
    assert _history_rows(sinks.read_history(spark, live.paths.history)) == _history_rows(st.upsert_view(flow.history))
    assert jobs.log_totals(spark, live.paths)["total"] == flow.topic_rows.count()


def test_a_stage_that_goes_on_failing_is_given_up_with_its_cause(spark, tmp_root):
    rows = [(e["order_id"], "orders", 0, n, "{}") for n, e in enumerate(_fail_pay("ORD-1"))]
    spark.createDataFrame(rows, "kafka_key string, topic string, partition int, offset long, raw_json string") \
        .write.parquet(f"{tmp_root}/source/b0")
    source = tp.file_topics(spark, f"{tmp_root}/source/*")
    broken = source.withColumn("raw_json", F.raise_error(F.lit("no such record")).cast("string"))
    live = LivePipeline(spark, broken, f"{tmp_root}/run", SOON, restarts=1, dedup_spread=None).start()
    with pytest.raises(StageFailed) as failed:
        live.run(120, poll=0.1)
    assert failed.value.stage == "validation" and "no such record" in str(failed.value.__cause__)
    assert not any(s.query.isActive for s in live.stages)
    live.stop()
