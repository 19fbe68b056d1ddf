"""Hot keys: a third of the rows on one key give the same results as the brute force."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from orderflow.operators.correlate import interval_join
from orderflow.operators.dedup import keep_first

BASE = datetime(2026, 10, 9)


def test_dedup_with_a_third_of_rows_as_copies(spark):
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("event_id"),
        (F.lit(BASE).cast("timestamp") + F.make_dt_interval(secs=(F.col("id") % 50).cast("decimal(18,6)"))).alias("event_timestamp"),
        F.lit("orders").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    out = {r.event_id: r.offset for r in keep_first(df, ["event_id"], ["event_timestamp", "topic", "partition", "offset"]).collect()}
    assert len(out) == 1 + (n - n // 3)
    assert out["HOT"] == 0   # earliest time (id % 50 == 0), then lowest offset


def test_interval_join_with_a_hot_key_over_many_buckets(spark):
    left = [("HOT", i, BASE + timedelta(minutes=7 * i)) for i in range(60)] + \
           [(f"K{i}", 100 + i, BASE + timedelta(minutes=i)) for i in range(60)]
    right = [("HOT", j, BASE + timedelta(minutes=3 * j + 1)) for j in range(150)] + \
            [(f"K{j}", 1000 + j, BASE + timedelta(minutes=j, seconds=30)) for j in range(60)]
    l = spark.createDataFrame(left, "k string, lid int, lt timestamp")
    r = spark.createDataFrame(right, "k string, rid int, rt timestamp")
    got = sorted((x.k, x.lid, x.rid) for x in interval_join(l, r, "k", "lt", "rt").collect())
    want = sorted((lk, li, ri) for lk, li, lt in left for rk, ri, rt in right
                  if lk == rk and lt <= rt <= lt + timedelta(minutes=15))
    assert got == want and len(got) > 200
