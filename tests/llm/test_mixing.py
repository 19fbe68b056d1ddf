"""The mix against a plain computation of its targets, its bounds, and rows that bite."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from orderflow.llm import mixing


def plain_targets(sizes, share=1.5, weights=(3.0, 1.0, 2.0), passes=2):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, targets = dict(sizes), {}
    rest = share * sum(sizes.values())
    while left:
        level = rest / sum(weight[s] for s in left)
        full = [s for s in left if weight[s] * level > passes * left[s]]
        if not full:
            return targets | {s: weight[s] * level for s in left}
        for s in full:
            targets[s] = float(passes * left.pop(s))
            rest -= targets[s]
    return targets


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {"size": F.lit(5), "words": F.lit("w"), "target": F.lit(1.0), "__mix_id": F.lit(9), "step": F.lit(0)})


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, "word " * (1 + i * 7919 % 400), ["hot", "hot", "a", "é", None][i % 5]) for i in range(400)]
    rows += [(900, None, "a"), (901, "", "b"), (902, " \t\n", "b"), (903, "x y z", "c"), (903, "x y z", "c"),
             (None, "one two", "c"), (903, "x y", "c"), (904, "w " * 30_000, "long")]
    return frame(spark, rows)


def test_targets_bounds_and_reruns(docs):
    got = mixing.op1(docs).collect()
    assert len(got) == docs.count()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r["size"]
    want = plain_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s], rel=1e-9)
        assert abs(taken[s] - want[s]) <= 1
    again = mixing.op1(docs.repartition(5)).collect()
    key = lambda r: (str(r.doc_id), str(r.source), r["size"], r.taken, r.target)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mixed_documents_are_whole_rows(docs):
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    times = {(r.doc_id, r.text): r["count"] for r in out.groupBy("doc_id", "text").count().collect()}
    copies = {(r.doc_id, r.text): r["count"] for r in docs.groupBy("doc_id", "text").count().collect()}
    assert all(n <= 2 * copies[k] for k, n in times.items())


def test_empty_and_wordless_tables(spark, docs):
    assert mixing.op1(docs.limit(0)).collect() == []
    assert mixing.mixed_documents(docs.limit(0)).count() == 0
    wordless = frame(spark, [(1, None, None), (2, "", "a")])
    assert [(r.taken, r.target) for r in mixing.op1(wordless).collect()] == [(0, 0.0)] * 2


def plain_taken(docs, share=1.5, passes=2):
    """The queues, one document after another, and one global order cut at the budget."""
    keyed = docs.select("doc_id", "source", mixing.source_key().alias("key"), mixing.text_key().alias("text_key"),
                        mixing.words_of().alias("size")).groupBy("doc_id", "source", "key", "text_key", "size") \
        .count().withColumn("pass", F.explode(F.array(F.lit(0), F.lit(1)))) \
        .withColumn("hash", F.xxhash64(F.lit(17), "pass", "doc_id", "text_key"))
    rows, sizes = keyed.collect(), defaultdict(int)
    for r in rows:
        sizes[r.source] += r["size"] * r["count"] * (r["pass"] == 0)
    goal = {s: int(t + 1e-9) for s, t in plain_targets(sizes, share, passes=passes).items()}
    sent = []
    for source in sizes:
        at = 0
        first = lambda r: (r["pass"], r.hash, r.doc_id is not None, r.doc_id or 0, r.text_key)
        for r in sorted((r for r in rows if r.source == source), key=first):
            words, key = r["size"] * r["count"], (r.doc_id, source, r.text_key)
            timely = max(0, min(words, goal[source] - at))
            for part, end in ((timely, at + timely), (words - timely, at + words)):
                if part:
                    sent.append(((end / goal[source] if goal[source] else float("inf"), r.key, r["pass"], r.doc_id is not None, r.doc_id or 0, r.text_key), part, key))
            at += words
    taken, left = defaultdict(int), sum(goal.values())
    for _, part, key in sorted(sent):
        taken[key] += min(part, left)
        left -= min(part, left)
    return {k: n for k, n in taken.items() if n}, sum(part for _, part, _ in sent)


def test_the_global_cut_takes_what_plain_queues_take(docs, monkeypatch):
    want, queued = plain_taken(docs)

    def served():
        rows = mixing.mix(docs).filter("served > 0").collect()
        return {(r.doc_id, r.source, r.text_key): r.served for r in rows}

    assert served() == want
    # without the cut the queues run to their ends: every document as often as there are passes
    monkeypatch.setattr(mixing, "truncated", lambda sent, budget: sent.withColumn("before", F.lit(0)))
    assert served() != want and sum(served().values()) == queued
