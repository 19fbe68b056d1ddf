"""Near copies against brute force over all pairs; the sketch and the exact similarity on their own."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderflow.llm import near_copies as nc
from orderflow.llm.components import components


def plain_similarity(a, b):
    """Probability Jaccard by its definition."""
    a, b = (dict(zip(*map(list, s))) for s in (a, b))
    return sum(1 / sum(max(a.get(y, 0) / a[x], b.get(y, 0) / b[x]) for y in a.keys() | b.keys())
               for x in a.keys() & b.keys())


def test_exact_similarity_and_estimate():
    rng = np.random.default_rng(1)
    gaps = []
    for _ in range(40):
        keys = np.unique(rng.integers(0, 1 << 60, 200).astype(np.uint64))
        weights = 1 + np.log(rng.integers(1, 5, len(keys)))
        a, b = ((keys[m], weights[m] * f) for m, f in ((rng.random(len(keys)) < 0.9, 1.0),
                                                       (rng.random(len(keys)) < 0.9, 3.0)))
        exact = nc.probability_jaccard(a, b)
        assert exact == pytest.approx(plain_similarity(a, b), abs=1e-9)
        first, second = nc.signatures([a, b])
        gaps.append((first == second).mean() - exact)
    assert abs(np.mean(gaps)) < 0.03 and np.std(gaps) < 0.08
    one = (keys[:1], weights[:1])
    assert (nc.signatures([one]) == keys[0]).all() and nc.probability_jaccard(one, one) == pytest.approx(1)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10 ** 6)}"
    return words


def texts():
    rng = random.Random(3)
    out = [" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(60, 200))) for _ in range(60)]
    base = [f"b{rng.randrange(3000)}" for _ in range(150)]
    out += [" ".join(edited(rng, base, n % 9)) for n in range(120)]  # a wide group about the threshold
    chain = [f"c{i}" for i in range(120)]
    for i in range(12):  # each near the next, the ends far apart
        chain = edited(rng, chain, 2)
        out.append(" ".join(chain))
    passage = " ".join(f"p{i}" for i in range(60))
    out += [f"{' '.join(f'q{rng.randrange(9999)}' for _ in range(90))} {passage}" for _ in range(25)]
    out += ["One, two three.", "one two three", "one two", "solo", "SOLO!", "line here again yes ok\n" * 40,
            "line here again yes ok\n" * 30, "é è ü ñ ç", "é è ü ñ ç!"]
    return out + out[:5]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts())]
    rows += [(5000, None), (5001, ""), (5002, " .,; "), (None, "one two three"), (7, rows[2][1])]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"node": F.lit("n"), "component": F.lit(1), "rows": F.lit(2), "__copy_id": F.lit(3), "bands": F.lit("b")})


def brute(rows):
    sets = [nc._shingled((t or "").encode()) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i][0]) and len(sets[j][0]) and nc.probability_jaccard(sets[i], sets[j]) >= nc.SIMILARITY:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group


@pytest.mark.parametrize("group", [512, 8])
def test_groups_equal_brute_force(docs, group, monkeypatch):
    monkeypatch.setattr(nc, "GROUP", group)  # small groups: many blocks, chunks and leaders' parts
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    parts = brute(rows)
    least = {}
    for (doc, _), part in zip(rows, parts):
        old = least.get(part)
        least[part] = doc if old is None else old if doc is None else min(old, doc)
    want = sorted((-1 if d is None else d, -1 if least[p] is None else least[p]) for (d, _), p in zip(rows, parts))
    got = nc.op6(docs).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, -1 if r.component_id is None else r.component_id)
                  for r in got) == want
    assert sum(r.kept for r in got) == len(set(parts))


def test_one_document_of_each_group_stays(docs):
    out = nc.without_copies(docs)
    assert out.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert out.count() == len(set(brute(rows)))
    twice = docs.union(docs).filter("doc_id < 5000")
    assert nc.without_copies(twice).count() == nc.without_copies(docs.filter("doc_id < 5000")).count()
    assert nc.op6(docs.limit(0)).collect() == [] and nc.without_copies(docs.limit(0)).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5)]
    got = components(spark.createDataFrame(links, "a long, b long"), "test-links").collect()
    assert {r.node: r.component for r in got} == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(50)}}
    assert len(got) == 111
    assert components(spark.createDataFrame([], "a long, b long"), "test-links").count() == 0
