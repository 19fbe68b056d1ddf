"""Spelling variants against all pairs of words, tiles of hot blocks, and rows that bite."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderflow.llm import spelling as sp


def plain_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_groups(ns):
    near = {w: [x for x in ns if abs(len(x) - len(w)) <= 1 and plain_near(w, x)] for w in ns}
    best = {w: min(found, key=lambda x: (-ns[x], x)) for w, found in near.items() if found}
    form = {w: x if ns[x] >= 10 * ns[w] else None for w, x in best.items()}
    out = {}
    for w in ns:
        root = w
        while form.get(root):
            root = form[root]
        f = form.get(w)
        out[w] = (f, root, ns[w], len(near[w]), ns[f] if f else None)
    return out


def got(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("tile", [2048, 8])
def test_equals_all_pairs(spark, tile):
    draw = random.Random(7)
    ns = {}
    for _ in range(500):
        letters = draw.choice(["ab", "abcé", "abcdefghÿ÷"])
        ns["".join(draw.choices(letters, k=draw.choice([7, 7, 8, 9, 30])))] = draw.choice([2, 3, 20, 30, 300, 5000])
    long = "".join(draw.choices("abc", k=4000))
    ns |= {long: 50, long[:77] + long[78:]: 4, long[:50] + "é" + long[51:]: 5}
    words = spark.createDataFrame(list(ns.items()), "word string, n long").withColumn("block", F.lit(1))
    assert got(sp.spelling_groups(words, tile=tile)) == plain_groups(ns)


def test_roots_follow_long_chains(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(37)] + [("x", "w3")], "word string, form string")
    assert {r.word: r.root for r in sp.roots(forms).collect()} == {f"w{i}": "w37" for i in range(37)} | {"x": "w37"}


def test_gram_products_give_all_close_rows():
    draw = np.random.default_rng(8)
    counts = draw.integers(0, 2, (300, sp.CLASSES)) * (np.arange(sp.CLASSES) < 6)
    starts, sizes = np.array([0, 3, 4, 40]), np.array([3, 1, 36, 260])
    i, j = sp.close_pairs(counts, starts, sizes)
    cell = np.repeat(np.arange(4), sizes)
    apart = ((counts[:, None] - counts[None]) ** 2).sum(2)
    a, b = np.nonzero((apart <= 2) & (cell[:, None] == cell) & (np.arange(300)[:, None] < np.arange(300)))
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(a.tolist(), b.tolist(), strict=True))


def plain_words(rows):
    import re
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def test_query_equals_brute_force(spark):
    draw = random.Random(9)
    stock = ["".join(draw.choices("aeinrstÉé", k=draw.randrange(6, 12))) for _ in range(60)]
    rows = [(i, draw.choice([" ", "-", "Ā", "1", "😀", " "]).join(draw.choices(stock, k=40))) for i in range(300)]
    rows += [(500, None), (501, ""), (502, "\n"), (None, "Windows windowS windows"), (503, "Windows windowS windows"),
             (503, "Windows windowS windows"), (504, "q" * 30_000), (505, "q" * 30_000), (506, "WORDS " * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit("w"), "n": F.lit(2)})
    ns = plain_words(rows)
    assert {r.word: r.n for r in sp.word_counts(docs).collect()} == ns
    assert got(sp.op11(docs)) == plain_groups(ns)
    assert sp.op11(docs.limit(0)).collect() == []
