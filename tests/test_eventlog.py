"""The derived event log follows its rule: counts per topic/type and anomalies, from pandas."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from orderflow.plans.flow import EventFlow

from conftest import SF_SMALL


def _expected():
    k = pq.read_table(f"{SF_SMALL}/orders.parquet", columns=["o_orderkey"]).to_pandas()["o_orderkey"]
    sc, r = k % 20, k % 211
    failed = (sc >= 15) & (sc < 18)
    has_inv = ~failed & (k % 101 != 7)
    second = k % 103 == 5
    dup = k % 50 == 0
    resent, recovers, second_sku = k % 107 == 3, failed & (k % 29 == 4), has_inv & (k % 113 == 6)
    inventory = has_inv.astype(int) + recovers.astype(int) + second_sku.astype(int)
    return {
        "orders_topic_rows": int(((r != 5)).sum() + (dup & (r != 5)).sum()),
        "payments_topic_rows": int(len(k) + second.sum() + resent.sum() + recovers.sum() + (r == 5).sum() + (dup & (r == 5)).sum()),
        "inventory_rows": int(inventory.sum()),
        "failed_payment_events": int(failed.sum() + (failed & second).sum() + (failed & resent).sum()),
        "null_values": int((r == 12).sum() + (dup & (r == 12)).sum()),
        "bad_keys": int((r == 3).sum() + (dup & (r == 3)).sum()),
        "quoted_quantity": int(inventory[r == 11].sum()),
    }


def test_log_follows_rule(spark):
    log = EventFlow(spark, SF_SMALL).topic_rows
    got = log.agg(
        F.count_if(F.col("topic") == "orders").alias("orders_topic_rows"),
        F.count_if(F.col("topic") == "payments").alias("payments_topic_rows"),
        F.count_if(F.col("topic") == "inventory-events").alias("inventory_rows"),
        F.count_if(F.col("raw_json").contains('"event_type":"payment_failed"')).alias("failed_payment_events"),
        F.count_if(F.col("raw_json").isNull()).alias("null_values"),
        F.count_if(F.col("kafka_key").startswith("BAD-")).alias("bad_keys"),
        F.count_if(F.col("raw_json").contains('"quantity":"1"')).alias("quoted_quantity"),
    ).first().asDict()
    assert got == _expected()


def test_offsets_unique_per_topic_partition(spark):
    log = EventFlow(spark, SF_SMALL).topic_rows
    dup = log.groupBy("topic", "partition", "offset").count().filter("count > 1").count()
    assert dup == 0



def test_explicit_splits_change_the_tasks_and_nothing_else(spark):
    from orderflow.operators import validate as va
    plain, dealt = EventFlow(spark, SF_SMALL), EventFlow(spark, SF_SMALL, splits=5)
    assert dealt.topic_rows.rdd.getNumPartitions() == 5
    key = ["kafka_key", "topic", "partition", "offset", "raw_json"]
    assert sorted(map(str, dealt.topic_rows.select(key).collect())) == sorted(map(str, plain.topic_rows.select(key).collect()))
    assert va.validation_counts(dealt.classified).collect() == va.validation_counts(plain.classified).collect()


def test_many_orders_are_dealt_to_tasks_by_their_rows(spark):
    from orderflow.plans.flow import dealt
    orders = spark.range(1000, numPartitions=2).withColumnRenamed("id", "o_orderkey")
    assert dealt(orders, 100).rdd.getNumPartitions() == 10
    assert dealt(orders, 100).agg({"o_orderkey": "sum"}).first()[0] == 499500
    assert dealt(orders, 500).rdd.getNumPartitions() == 2  # small enough: no shuffle
