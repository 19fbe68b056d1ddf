"""Batch dedup keeps one deterministic row per key (A, A, B -> 2)."""

from datetime import datetime

from orderflow.operators.dedup import dedup, keep_first

T = datetime(2026, 10, 9, 1, 0, 0)


def test_three_in_two_out(spark):
    df = spark.createDataFrame(
        [("A", T, "orders", 0, 2, "x"), ("A", T, "orders", 0, 1, "x"), ("B", T, "orders", 1, 3, "y")],
        "event_id string, event_timestamp timestamp, topic string, partition int, offset long, v string")
    rows = sorted((r.event_id, r.offset) for r in dedup(df).collect())
    assert rows == [("A", 1), ("B", 3)]


def test_keep_first_by_order(spark):
    df = spark.createDataFrame([("k", 3, "c"), ("k", 1, "a"), ("k", 2, "b"), ("j", 5, "z")],
                               "key string, o int, v string")
    assert sorted(tuple(r) for r in keep_first(df, ["key"], ["o"]).collect()) == [("j", 5, "z"), ("k", 1, "a")]
