"""The tree-merge against a plain grouping, its verification, and rows that bite."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from orderflow.llm import exact_dedup


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"leaf": F.lit(5), "rid": F.lit("w"), "id": F.lit(1.0), "digest": F.lit(9), "row": F.lit(0), "best": F.lit(1)})


ROWS = [(i, ["hot\x0btext ", "hot  text", "h o t text"][i % 3]) for i in range(300)]
ROWS += [(400 + i, f"other {i % 40}") for i in range(200)]
ROWS += [(700, None), (701, ""), (702, " \t\n"), (703, " "), (703, " "), (None, "no id"), (704, "no  id"), (705, "noid"),
         (None, "  no id"), (710, "x " * 60_000), (709, "x" * 60_000), (711, "é 😀"), (712, "é😀 "), (713, "É😀")]


def plain(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub("[\x20\x09-\x0d]", "", text or "")].append((-len(text or ""), i is None, i or 0, i))
    out = []
    for norm, members in groups.items():
        keep, left = min(members)[3], True
        for member in sorted(members):
            out.append((member[3], keep, len(members), left, hashlib.sha256(norm.encode()).hexdigest()))
            left = False
    return sorted(out, key=str)


@pytest.mark.parametrize("width", [1, 2, 8, 100])
def test_equals_a_plain_grouping(spark, width):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(width))
    try:
        got = exact_dedup.op12(frame(spark, ROWS).repartition(7)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got), key=str) == plain(ROWS)


def test_rows_of_one_digest_merge_only_when_verified(spark):
    runs = spark.range(64).select(
        (F.col("id") % 8).cast("int").alias("node"), F.lit(-77).cast("long").alias("digest"),
        F.unhex(F.sha2((F.col("id") % 3).cast("string"), 256)).alias("sha"), (F.col("id") % 2).cast("int").alias("n_bytes"),
        F.lit(1).cast("long").alias("size"), F.struct("id").alias("best"))
    got = exact_dedup.tree_merge(runs, 3)
    assert sorted((r["size"], r.best.id) for r in got.collect()) == [(10, 4), (10, 5), (11, 0), (11, 1), (11, 2), (11, 3)]
    # one digest ends in one node: its top three bits
    assert {r.node for r in got.select("node").distinct().collect()} == {7}


def test_every_round_is_native_and_merges_where_it_was_dealt(spark):
    runs = spark.range(10).select(F.lit(0).alias("node"), F.xxhash64("id").alias("digest"), F.unhex(F.lit("00")).alias("sha"),
                                  F.lit(1).alias("n_bytes"), F.lit(1).alias("size"), F.struct("id").alias("best"))
    plan = exact_dedup.tree_merge(runs, 8)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 3 and "Python" not in plan and "Arrow" not in plan


def test_without_copies_returns_whole_rows(spark):
    docs = frame(spark, ROWS)
    out = exact_dedup.without_copies(docs)
    assert out.dtypes == docs.dtypes
    assert out.count() == sum(r[3] for r in plain(ROWS))
    assert exact_dedup.op12(docs.limit(0)).collect() == []
