"""The staged batch backfill writes the same history as the lazy flow; lookups prune."""

from orderflow.operators import states as st
from orderflow.plans import backfill
from orderflow.plans import history as hi
from orderflow.plans.flow import EventFlow

from conftest import SF_SMALL


def test_backfill_history_and_lookup(spark, tmp_root):
    flow = EventFlow(spark, SF_SMALL)
    tables = backfill.run_backfill(spark, flow.topic_rows, f"{tmp_root}/bf", buckets=8)
    hist = hi.read(spark, tables.path("history"))
    want = st.upsert_view(flow.history)
    cols = ["order_id", "state_id", "order_status", "inventory_status"]
    assert sorted(map(tuple, hist.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    some = want.first().order_id
    found = backfill.lookup(spark, tables, some)
    assert {r.order_id for r in found.collect()} == {some}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_bucket" in plan and "PushedFilters" in plan
    report = {r.stage: r.row_count for r in backfill.read_table(spark, tables, "report").collect()}
    assert report["history_rows"] == want.count()
    assert report["topic_rows"] == report["valid_events"] + report["invalid_events"]
    for key in want.limit(5).collect():  # whatever the number of buckets
        assert backfill.lookup(spark, tables, key.order_id).count() >= 1
    hi.compact(spark, tables.path("history"), f"{tmp_root}/compact")
    assert hi.read(spark, f"{tmp_root}/compact").count() == want.count()
    assert hi.stored_buckets(spark, f"{tmp_root}/compact") == 8
    dl = backfill.read_table(spark, tables, "dead_letters")
    assert dl.count() == flow.classified.filter("validation_status = 'INVALID'").count()
