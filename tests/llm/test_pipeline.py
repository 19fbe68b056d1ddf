"""The pipeline's stages on planted documents, and the registration of the queries."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline

N = 260


def spoken(rng, n):
    return [f"{rng.choice('bcdfglmnprst')}{rng.choice('aeiou')}{rng.choice('lnrst')}{rng.choice('aeiou')}" for _ in range(n)]


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng = random.Random(12)
    folder = str(tmp_path_factory.mktemp("planted"))
    clean = {i: " ".join(spoken(rng, rng.randrange(40, 160))) for i in range(N)}
    toxic = {1000 + i: " ".join([*spoken(rng, 60), "wretch", *spoken(rng, 20), "scumbag", "idiotic"]) for i in range(40)}
    exact = {2000 + i: clean[i].upper() if i % 2 else clean[i] for i in range(10)}
    near = {2100 + i: " ".join(["changed", *clean[20 + i].split()[1:]]) for i in range(10)}
    items = [(i, " ".join(spoken(rng, 30))) for i in range(5)]
    leaked = {3000 + i: " ".join([*spoken(rng, 50), *items[i % 5][1].split()[3:20], *spoken(rng, 50)]) for i in range(15)}
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for part in (clean, toxic, exact, near, leaked) for i, t in part.items()]
    rows += [(4000, None, None, None, None), (4001, "", "en", "s1", 0), (None, "a b c", "en", None, 5)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, 1, 0) for i in range(0, N, 2)] + [(i, 1, 1) for i in toxic if i % 2 == 0]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, clean, toxic, exact, near, leaked


def test_stages_take_out_what_is_planted_and_nothing_else(spark, planted, tmp_root):
    folder, clean, toxic, exact, near, leaked = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("_key", F.lit("extra"))
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_copies", "decontamination", "mixing", "tokens"]
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "tokens":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_root}/{name}")
        docs = spark.read.parquet(f"{tmp_root}/{name}")
        left[name] = sorted(-1 if r.doc_id is None else r.doc_id for r in docs.select("doc_id").collect())
    rest = sorted([*clean, *exact, *near, *leaked, 4000, 4001, -1])
    assert left["toxicity"] == rest
    assert left["near_copies"] == sorted([*clean, *leaked, 4000, 4001, -1])
    assert left["decontamination"] == sorted([*clean, 4000, 4001, -1])
    assert set(left["mixing"]) <= set(left["decontamination"]) and len(left["mixing"]) > len(clean)
    assert max(left["mixing"].count(i) for i in set(left["mixing"])) == 2
    assert left["tokens"] == left["mixing"]


def test_run_gives_the_same_documents(spark, planted):
    folder = planted[0]
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert got.count() > N


def test_empty_tables_repeated_rows_and_long_texts(spark, planted, tmp_root):
    folder, clean = planted[:2]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_root}/empty/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_root}/empty").collect() == []
    # neither labels nor benchmark: nothing is toxic or leaked; equal rows leave one, a long text passes whole
    rng = random.Random(13)
    long = " ".join(w for _ in range(300) for w in spoken(rng, 100))
    odd = spark.createDataFrame([(1, clean[1], "en", "s1", 1)] * 3 + [(5000, long, "en", "s0", None)], docs.schema)
    odd.unionByName(docs.filter("doc_id BETWEEN 100 AND 104")).write.parquet(f"{tmp_root}/odd/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_root}/odd/{name}.parquet")
    docs = spark.read.parquet(f"{tmp_root}/odd/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        stage(spark, docs, f"{tmp_root}/odd").write.parquet(f"{tmp_root}/{name}")
        docs = spark.read.parquet(f"{tmp_root}/{name}")
    assert sorted(r.doc_id for r in docs.collect()) == [1, 100, 101, 102, 103, 104, 5000]
    assert docs.filter("doc_id = 5000").first().text == long


def test_queries_are_registered_one_for_each_operator():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n[2].isdigit()) == list(range(1, 14))
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
