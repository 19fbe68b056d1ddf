"""Keyed tables: versions, replays, merges, readers meanwhile, lookups; current state on the stream."""

import json
import random
import threading

from pyspark.sql import functions as F

from orderflow.operators import states as st
from orderflow.plans import backfill
from orderflow.plans import history as hi
from orderflow.plans.flow import EventFlow
from orderflow.plans.keyed import Entry, KeyedTable
from orderflow.sources import topics as tp
from orderflow.streaming import jobs, sinks

from conftest import SF_SMALL


def _largest(rows):
    return rows.groupBy("order_id").agg(F.max("n").alias("n"))


def _table(root):
    return KeyedTable(f"{root}/table", _largest, buckets=4)


def _rows(spark, pairs):
    return spark.createDataFrame(pairs, "order_id string, n long")


def _read(table, spark, snapshot=None):
    return {r.order_id: r.n for r in table.read(spark, snapshot).collect()}


def scan_metrics(df):
    """Metrics of the parquet scans of a frame that was run."""
    found = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name.startswith("Scan parquet"):
            metrics, it = {}, node.metrics().iterator()
            while it.hasNext():
                pair = it.next()
                metrics[pair._1()] = pair._2().value()
            found.append(metrics)
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    df.collect()
    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_a_replay_replaces_its_own_rows_and_nothing_else(spark, tmp_root):
    table = _table(tmp_root)
    table.append(_rows(spark, [("a", 1), ("b", 9)]), "q/0")
    table.append(_rows(spark, [("a", 5)]), "q/1")
    table.append(_rows(spark, [("a", 2)]), "other/0")
    table.append(_rows(spark, [("a", 1), ("c", 3)]), "q/0")  # the batch again, with other rows
    assert _read(table, spark) == {"a": 5, "c": 3}
    table.append(_rows(spark, []), "q/2")
    assert _read(table, spark) == {"a": 5, "c": 3}


def test_readers_keep_their_version_while_the_table_is_merged_and_replaced(spark, tmp_root):
    table = _table(tmp_root)
    for n in range(5):
        table.append(_rows(spark, [("a", n), (f"k{n}", n)]), f"q/{n}")
    before = table.snapshot(spark)
    frame = table.read(spark)  # planned on the version before, run after
    assert table.compact(spark, fan_in=2) == 3  # 5 folders: 2 merges of level 0, one of level 1
    after = table.snapshot(spark)
    assert sorted(e.level for e in after.entries) == [0, 2]
    assert _read(table, spark) == _read(table, spark, before) == {r.order_id: r.n for r in frame.collect()}
    table.replace(_rows(spark, [("z", 1)]))
    assert _read(table, spark) == {"z": 1}
    assert len(_read(table, spark, before)) == 6
    # nothing goes before its time; then all but the latest version's folder
    assert table.expire(spark, keep=1) == []
    gone = table.expire(spark, keep=1, grace_seconds=0)
    assert len(gone) == 8 and _read(table, spark) == {"z": 1}


def test_writers_at_once_lose_nothing(spark, tmp_root):
    table = _table(tmp_root)
    writers = [threading.Thread(target=lambda n=n: table.append(_rows(spark, [(f"k{n}", n)]), f"q{n}/0")) for n in range(6)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert _read(table, spark) == {f"k{n}": n for n in range(6)}
    assert table.snapshot(spark).version == 5


def test_a_merge_of_replaced_folders_is_given_up(spark, tmp_root):
    table = _table(tmp_root)
    table.append(_rows(spark, [("a", 7)]), "q/0")
    table.append(_rows(spark, [("b", 1)]), "q/1")
    slow = table._write

    def write(rows, buckets):  # while the merge is written, the first batch is replayed without its row
        folder = slow(rows, buckets)
        if not replayed:
            replayed.append(1)
            table._commit(spark, rows.schema, 4, lambda old: [old[1], Entry(slow(_rows(spark, [("c", 1)]), 4), "q/0")])
        return folder

    replayed = []
    table._write = write
    assert table.compact(spark, fan_in=1) == 0
    assert _read(table, spark) == {"b": 1, "c": 1}


def test_lookups_read_one_bucket_and_skip_files_without_the_key(spark, tmp_root):
    table = KeyedTable(f"{tmp_root}/table", _largest, buckets=4)
    for n in range(6):
        table.append(spark.range(2000).select(F.concat(F.lit(f"{n}-"), "id").alias("order_id"), "id")
                     .withColumnRenamed("id", "n"), f"q/{n}")
    one = table.lookup(spark, "3-77")
    assert [tuple(r) for r in one.collect()] == [("3-77", 77)]
    (scan,) = scan_metrics(one)
    assert scan["numPartitions"] == 6  # one bucket of each of the six folders
    assert scan["numOutputRows"] <= 2000  # of about 3,000 rows of the bucket: files without the key give none
    keys = _rows(spark, [("1-5", 0), ("4-1999", 0), ("none", 0)])
    some = table.lookup_many(spark, keys)
    assert sorted(tuple(r) for r in some.collect()) == [("1-5", 5), ("4-1999", 1999)]
    buckets = {r[0] for r in keys.select(hi.order_bucket("order_id", 4)).collect()}
    assert sum(s["numPartitions"] for s in scan_metrics(some)) == 6 * len(buckets) < 24


def test_bloom_filters_skip_row_groups_inside_the_range_of_keys(spark, tmp_root):
    table = KeyedTable(f"{tmp_root}/table", _largest, buckets=1)
    table.append(spark.range(0, 4000, 2).select(F.lpad(F.col("id").cast("string"), 8, "0").alias("order_id"), "id")
                 .withColumnRenamed("id", "n"), "q/0")
    missing = table.lookup(spark, "00000777")  # odd: within the file's smallest and largest key
    assert missing.collect() == []
    assert sum(s["numOutputRows"] for s in scan_metrics(missing)) == 0


def test_a_second_backfill_leaves_exactly_its_own_history(spark, tmp_root):
    flow = EventFlow(spark, SF_SMALL)
    tables = backfill.run_backfill(spark, flow.topic_rows, f"{tmp_root}/bf", buckets=8)
    first = backfill.read_table(spark, tables, "history").count()
    fewer = flow.topic_rows.filter(F.pmod(F.xxhash64("kafka_key"), F.lit(3)) == 0)
    backfill.run_backfill(spark, fewer, f"{tmp_root}/bf", buckets=8)
    rows = {tuple(r) for r in backfill.read_table(spark, tables, "history").select("order_id", "state_id").collect()}
    states = st.history_rows(backfill.read_table(spark, tables, "states"))
    assert rows == {tuple(r) for r in states.select("order_id", "state_id").collect()}
    assert 0 < len(rows) < first
    report = {r.stage: r.row_count for r in backfill.read_table(spark, tables, "report").collect()}
    assert report["history_rows"] == len(rows)


def _state_files(spark, root, batches):
    for n, rows in enumerate(batches):
        spark.createDataFrame([(r["order_id"], json.dumps(r)) for r in rows], "key string, value string") \
            .coalesce(1).write.parquet(f"{root}/b{n:02d}")


def test_current_state_on_the_stream_equals_batch_after_disorder_and_replay(spark, tmp_root):
    draw, rows = random.Random(3), []
    for k in range(60):
        for n in range(draw.choice([1, 1, 2, 3])):
            paid = draw.random() < 0.5
            rows.append({"order_id": f"ORD-{k}", "customer_id": "C", "order_amount": 1.5 + n,
                         "order_time": f"2026-10-09 01:00:{k:02d}",
                         "payment_status": "payment_authorized" if paid else "payment_failed",
                         "order_status": "COMPLETED" if paid else "PAYMENT_FAILED",
                         "decided_at": f"2026-10-09 01:{draw.randrange(10, 40)}:00"})
    draw.shuffle(rows)  # decisions arrive in any order
    batches = [rows[n::7] for n in range(7)]
    _state_files(spark, f"{tmp_root}/states", batches)
    source = tp.key_value_files(spark, f"{tmp_root}/states/*", max_files_per_trigger=1)
    schema = source.schema
    query = jobs.run_to_end(jobs.run_current(source, f"{tmp_root}/current", f"{tmp_root}/ck"))
    parsed = st.parse_states(spark.read.schema(schema).parquet(f"{tmp_root}/states/*"))
    columns = ["order_id", "order_status", "payment_status", "order_amount", "state_id"]

    def want():
        return sorted(tuple(r) for r in st.current_state(st.history_rows(parsed)).select(columns).collect())

    def got():
        return sorted(tuple(r) for r in sinks.read_current(spark, f"{tmp_root}/current").select(columns).collect())

    assert got() == want() and len(got()) == 60
    # a batch delivered again, by itself and after folders were merged
    callback = sinks.upsert_current(f"{tmp_root}/current", fan_in=3)
    again = st.parse_states(spark.read.schema(schema).parquet(f"{tmp_root}/states/b02"))
    callback(again, 2, str(query.id))
    assert got() == want()
    levels = [e.level for e in hi.current(f"{tmp_root}/current").snapshot(spark).entries]
    assert max(levels) >= 1 and len(levels) < 7
    callback(again, 2, str(query.id))
    assert got() == want()
