"""Per-key positions with hot keys and bursts, against brute force; the share of one task."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderflow.operators import sequence as sq

N = 6000
HOT = "CASE WHEN id % 3 = 0 THEN 'HOT' ELSE concat('K', id % 97) END"
TIMES = {
    "spread over hours": "timestamp_seconds(((id * 7919) % 1000) * 60)",
    "all in one second": "timestamp_micros((id * 7919) % 1000000)",
    "all at one time": "timestamp_seconds(5)",
    "all null": "CAST(NULL AS timestamp)",
    "half null": "CASE WHEN id % 2 = 0 THEN timestamp_seconds(id) END",
}


@pytest.mark.parametrize("times", TIMES)
def test_a_hot_key_is_numbered_like_row_number_and_dealt_over_tasks(spark, times):
    df = spark.range(N).select(F.expr(HOT).alias("key"), F.expr(TIMES[times]).alias("t"),
                               F.concat(F.lit("E"), F.hash("id").cast("string"), F.lit("-"), "id").alias("uid"))
    by = Window.partitionBy("key").orderBy(F.col("t").asc_nulls_first(), "uid")
    want = {r.uid: r.pos for r in df.withColumn("pos", F.row_number().over(by)).collect()}
    got = sq.sequence_within(df, "key", ["t", "uid"], "pos", ranges=24)
    assert {r.uid: r.pos for r in got.collect()} == want
    # a third of the rows is one key; no range, and so no task, holds more than an eighth
    sizes = [r["count"] for r in sq.ranged_rows(df, ["key", "t", "uid"], 24).groupBy(sq.RANGE).count().collect()]
    assert max(sizes) <= N / 8 and len(sizes) >= 16


def test_null_keys_are_one_key_and_null_times_come_first(spark):
    df = spark.sql("""SELECT * FROM VALUES (NULL, timestamp'2026-01-01 00:00:00', 1), (NULL, NULL, 2),
        (NULL, timestamp'2026-01-02 00:00:00', 3), ('A', timestamp'2026-01-01 00:00:00', 4)
        AS rows(key, t, uid)""")
    for ranges in (1, 3, 8):
        got = {r.uid: r.pos for r in sq.sequence_within(df, "key", ["t", "uid"], "pos", ranges).collect()}
        assert got == {2: 1, 1: 2, 3: 3, 4: 1}
    assert sq.sequence_within(df.limit(0), "key", ["t", "uid"], "pos").collect() == []


def test_what_crosses_ranges_is_two_rows_a_range(spark):
    df = spark.range(N).select(F.expr(HOT).alias("key"), F.col("id").alias("t"))
    rows = sq.ranged_rows(df, ["key", "t"], 16)
    earlier = sq.rows_in_earlier_ranges(rows, "key")
    assert earlier.count() <= 32
    hot = sorted((r["_at"], r[sq.EARLIER]) for r in earlier.filter("_key = 'HOT'").collect())
    counts = dict(rows.filter("key = 'HOT'").groupBy(sq.RANGE).count().collect())
    assert hot == [(at, sum(n for r, n in counts.items() if r < at)) for at, _ in hot]
