"""Runs against a scan of every lag, the query's words, and rows that bite."""

import hashlib
import random
import time
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderflow.llm import periodic_runs as pr


def plain_runs(words, shortest=12):
    """Maximal stretches of every lag; of equal stretches the smallest lag is the period."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(shortest, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, b - a, q) for (a, b), q in found.items())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from([b"a", b"b", b"c", b"dd"]), min_size=1, max_size=15), st.integers(1, 6)), max_size=8))
def test_equals_a_scan_of_every_lag(parts):
    words = [w for part, times in parts for w in part * times]
    assert pr.runs(words) == plain_runs(words)


def test_long_periods_and_dense_runs():
    draw = random.Random(4)
    for words in range(40):
        words = [b"%d" % draw.randrange(draw.choice([3, 40, 400])) for _ in range(draw.randrange(600))]
        for _ in range(2):
            if words:
                a = draw.randrange(len(words))
                p = draw.randrange(1, (len(words) - a) // 2 + 2)
                words[a:] = [words[a + i % p] for i in range(min(len(words) - a, p * 4))]
        assert pr.runs(words) == plain_runs(words)
    a, b = [b"0"], [b"0", b"1"]
    while len(b) < 700:
        a, b = b, b + a
    assert pr.runs(b) == plain_runs(b)


def test_splitting_leaves_only_words_that_recur():
    words = b"a b c one a b c two a b c a b c a b c a b c three".split()
    assert pr.segments(pr.numbered(words)) == [(8, 20)]
    assert pr.segments(pr.numbered([b"%d" % i for i in range(1000)])) == []


def test_long_texts_take_little_time():
    began = time.time()
    draw = random.Random(5)
    assert pr.runs([b"w"] * 100_000) == [(0, 100_000, 1)]
    assert pr.runs([b"%d" % (i % 777) for i in range(100_000)]) == [(0, 100_000, 777)]
    pr.runs([b"%d" % draw.randrange(2) for _ in range(100_000)])
    assert time.time() - began < 60


def plain_query(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    drop = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (doc_id, len(runs), *(best + (1000 * best[1] // best[2],) if best else [None] * 4),
            hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in drop)).hexdigest())


def test_query_equals_brute_force(spark):
    draw = random.Random(6)
    rows = [(i, " ".join(draw.choices(["é", "b b", "c", "d", "e "], k=draw.randrange(90)))) for i in range(300)]
    rows += [(400, None), (401, ""), (402, " \t"), (None, "a b " * 9), (403, "x\x0by\x0c" * 8), (403, "x\x0by\x0c" * 8),
             (404, "w " * 3000), (405, " ".join(f"{i} {i % 9}" for i in range(2000)) + " p q r" * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"row": F.lit(1), "n_runs": F.lit(2)})
    got = [tuple(r) for r in pr.op13(docs).collect()]
    assert sorted(got, key=str) == sorted((plain_query(*r) for r in rows), key=str)
    assert pr.op13(docs.limit(0)).collect() == []


def test_collapsed_keeps_other_texts_and_columns(spark):
    rows = [(1, "say it " + "again and " * 20 + "done"), (2, "one  two\n"), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"row": F.lit(1), "odd.name": F.lit(2)})
    out = pr.collapsed(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "say it again and done", 2: "one  two\n", 3: None, 4: ""}


@pytest.mark.parametrize("words", [[], [b"a"] * 11, [b"a"] * 12, [b"a", b"b"] * 6])
def test_edges_of_length(words):
    assert pr.runs(words) == plain_runs(words)
