"""Language model, embedding links and page text: held-out gain, brute force, rows that bite."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderflow.llm import embedding_dedup, hnsw, html_text, lm


# ---------------------------------------------------------------- language model
def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def base_scores(rows):
    train = Counter()
    for doc, text in rows:
        if zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 != 2:
            train.update(tokens(text))
    total, distinct = sum(train.values()), len(train)
    return total, [(-1 if d is None else d, len(tokens(t)), sum(train[w] > 0 for w in tokens(t)),
                    round(sum(math.log10((train[w] + 1) / (total + distinct + 1)) for w in tokens(t)), 4))
                   for d, t in rows]


@pytest.fixture(scope="module")
def spoken():
    rng = random.Random(6)
    tongues = [[f"{p}{i}" for i in range(60)] for p in ("a", "b", "c")]
    rows = [(i, " ".join(rng.choice(tongues[i % 3]) if rng.random() > 0.02 else f"rare{rng.randrange(10 ** 6)}"
                         for _ in range(rng.randrange(10, 200)))) for i in range(400)]
    return rows + [(900, None), (901, ""), (902, "A1\ta1\x0bB1\x1ca\xa0b"), (903, "a1 a2"), (903, "a1 a2"),
                   (None, "b1"), (904, "c1 " * 20_000)]


def test_scores_and_held_out_gain(spark, spoken, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 120)  # most words are counted by the join
    docs = spark.createDataFrame(spoken, "doc_id long, text string").withColumns(
        {c: F.lit("x") for c in ("row", "word", "c", "ids", "held_out", "told", "n")})
    got = lm.scores(docs).collect()
    total, want = base_scores(spoken)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 4))
                  for r in got) == sorted(want)
    assert {r.train_tokens for r in got} == {total}
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 400]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.05 * sum(r.n_tokens for r in held)
    assert lm.scores(docs.limit(0)).collect() == []
    only_held = docs.filter("doc_id = %d" % next(r.doc_id for r in held))
    (alone,) = lm.scores(only_held).collect()
    assert (alone.train_tokens, alone.n_known, alone.base_score) == (0, 0, 0.0)


def text_batch(texts):
    n = len(texts)
    return pa.record_batch({"row": pa.array(range(n), pa.int64()), "doc_id": pa.array(range(n), pa.int64()),
                            "held_out": pa.array([False] * n), "text": pa.array(texts, pa.string())})


ODD_TEXTS = [None, "", " ", "\x0b\x0c", "A b\tÉ\x1cx\xa0y  ", "a", "Ünï ẞ a\r\nA", *(f"w{i} W{i % 7} a " * 3 for i in range(60))]


def test_totals_are_those_of_all_slices(monkeypatch):
    monkeypatch.setattr(lm, "HELD_WORDS", 10)  # handed on between slices
    batch = text_batch(ODD_TEXTS)
    got = Counter()
    for out in lm.token_totals(batch.slice(i, 9) for i in range(0, len(ODD_TEXTS), 9)):
        for word, n in zip(*(c.to_pylist() for c in out.columns)):
            got[word] += n
    assert got == sum((Counter(tokens(t)) for t in ODD_TEXTS), Counter())
    assert [*lm.token_totals(iter([]))] == []


def test_words_of_a_slice_are_looked_up_once(monkeypatch):
    looked = []

    class Numbers(dict):
        def get(self, word, default=None):
            looked.append(word)
            return super().get(word, default)

    words = [b"", b"a", b"w1"]
    known = lm.Vocabulary(words, np.array([9, 5, 2]), 16, 3, 2)
    monkeypatch.setattr(lm, "_numbered", lambda *_: Numbers({w: i for i, w in enumerate(words)}))
    batch = text_batch(ODD_TEXTS)
    (out,) = lm.encoded("x", type("Shared", (), {"value": known}))(iter([batch.slice(4, 40)]))
    for text, ids, rare, n in zip(ODD_TEXTS[4:44], out["ids"].to_pylist(), out["rare"].to_pylist(), out["n_tokens"].to_pylist()):
        want = tokens(text)
        assert np.frombuffer(ids, "<u4").tolist() == [words.index(w) + 1 if w in words else 0 for w in want]
        assert (rare, n) == ([w for w in want if w not in words], len(want))
    assert len(looked) == len(set(looked))


def test_a_step_moves_only_the_rows_it_met():
    unigram = np.full(40, 1 / 40)
    model = lm.LogBilinear.fresh(unigram)
    trainer, before = lm.Trainer(model, unigram, 1), model.copy()
    for part, square, grad in zip(model.parts(), trainer.squares, trainer.grads):
        assert square.shape == grad.shape == part.shape
    trainer.step(np.array([3, 3]), np.array([1, 2]), np.array([2, 5]))
    assert np.flatnonzero((model.inputs != before.inputs).any(axis=1)).tolist() == [1, 2, 5]
    assert not any(g.any() for g in trainer.grads)


def test_probabilities_add_up_to_one():
    unigram = np.array([0.3, 0.25, 0.2, 0.15, 0.1])
    model = lm.LogBilinear.fresh(unigram)
    trainer, rng = lm.Trainer(model, unigram, 1), np.random.default_rng(0)
    for _ in range(300):  # the word after 2 is always 3
        word, near, far = rng.integers(0, 5, 512), rng.integers(0, 5, 512), rng.integers(0, 5, 512)
        trainer.step(np.where(near == 2, 3, word), near, far)
    near, far, norms = model.log_normalised()
    p = np.exp(near[:, None, :] + far[None, :, :] - norms[:, :, None])
    assert np.allclose(p.sum(axis=2), 1, atol=1e-4) and p[2, :, 3].min() > 0.6


def test_words_of_the_tail_are_told_by_their_context(spark, spoken, monkeypatch):
    monkeypatch.setattr(lm, "MODEL_WORDS", 20)  # most words are in the tail, half of those without a number
    monkeypatch.setattr(lm, "FREQUENT", 100)
    docs = spark.createDataFrame(spoken[:400] * 4, "doc_id long, text string")
    held = [r for r in lm.scores(docs).collect() if r.held_out and r.doc_id < 400]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.01 * sum(r.n_tokens for r in held)


def test_a_class_adds_up_to_its_share():
    rng = np.random.default_rng(2)
    model = lm.LogBilinear.fresh(np.full(50, 0.02))
    learnt = np.zeros(4000, lm.TAIL)
    learnt["near"], learnt["far"] = rng.integers(0, 50, (2, 4000))
    learnt["key"] = np.where(learnt["near"] < 25, 7, rng.integers(0, 30, 4000))  # 7 follows half of the words
    learnt["key"][:6] = [100, 100, 101, 102, 103, 103]  # rarer words
    words, counts = np.unique(learnt["key"], return_counts=True)
    asked = np.zeros(2 * (len(words) + 1), lm.TAIL)
    asked["held"], asked["key"] = 1, [*words, 999] * 2  # 999 is new
    asked["near"][len(words) + 1:] = 40
    gains = lm.class_gains(np.append(learnt, asked), model, 1)[len(learnt):].reshape(2, -1)
    shares = (counts + 1) / (counts + 1).sum()
    assert np.allclose((shares * np.exp(gains[:, :-1])).sum(axis=1), 1, atol=1e-4) and not gains[:, -1].any()
    assert gains[0, 7] > gains[1, 7] and np.ptp(gains[0, -5:-1]) < 1e-5
    tokens = np.append(learnt, asked)
    assert (lm.unpacked_tokens(lm.packed_tokens(tokens)) == tokens).all()


# ---------------------------------------------------------------- embeddings
def brute(ids, vectors):
    ok = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for v in vectors]
    n = len(ids)
    links = np.zeros((n, n), bool)
    scaled = [np.array(v, float) / np.abs(np.array(v, float)).max() if k else None for v, k in zip(vectors, ok)]
    unit = [v / np.linalg.norm(v) if k else None for v, k in zip(scaled, ok)]
    for i in range(n):
        for j in range(n):
            links[i, j] = i != j and ok[i] and ok[j] and len(vectors[i]) == len(vectors[j]) and unit[i] @ unit[j] >= 0.95
    group = list(range(n))
    for i in range(n):
        for j in np.flatnonzero(links[i]):
            old, new = group[i], group[j]
            if old != new:
                group = [new if g == old else g for g in group]
    return links.sum(axis=1), group


def test_embedding_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "SHARD_ROOT", 6)  # several shards
    rng = np.random.default_rng(3)
    vectors = [rng.normal(size=16).tolist() for _ in range(250)]
    centre = rng.normal(size=16)
    vectors += [(centre + rng.normal(size=16) * 0.03).tolist() for _ in range(130)]  # a cluster wider than a beam
    for i in range(60):
        vectors.append((np.array(vectors[i]) * 3 + rng.normal(size=16) * rng.choice([0.02, 0.6, 0.9])).tolist())
    vectors += [None, [], [0.0] * 16, [1.0, None] + [0.0] * 14, [float("nan")] * 16, [float("inf")] + [0.0] * 15,
                [1.0, 2.0], [2.0, 4.0], [2.0, 4.0], [1e200] * 16, [1e-200] * 16]
    ids = list(range(100, 100 + len(vectors)))
    ids[-3], vectors[-4] = ids[-4], vectors[-3]  # a repeated row
    rows = list(zip(ids, vectors))
    got = embedding_dedup.op5(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(
        {c: F.lit("x") for c in ("key", "shard", "size", "links", "label")})).collect()
    count, group = brute(ids, vectors)
    least = {}
    for i, g in zip(ids, group):
        least[g] = min(i, least.get(g, i))
    want = sorted((i, int(c), least[g]) for i, c, g in zip(ids, count, group))
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_dedup.op5(empty).collect() == []


def test_beams_widen_until_the_audit_passes():
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(3000, 24)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    graph = hnsw.build(vectors)
    width, recall = hnsw.audited_width(graph, 0.95, 0.99, 200, 1)
    assert recall >= 0.99 and width > 1
    found = graph.within(vectors, 0.95, width)
    assert len(found[0]) >= 0.99 * (vectors @ vectors.T >= 0.95).sum()


# ---------------------------------------------------------------- page text
PAGES = {
    "<p>One<p>Two <b>bold</b>\n x<br>line": "One\n\nTwo bold x\nline",
    "<ul><li>a<li>b<ul><li>b1<li>b2</ul><li>c</ul>": "- a\n- b\n  - b1\n  - b2\n- c",
    "<ol start=9><li>nine<li><p>ten</ol>": "9. nine\n10. ten",
    "<table><caption>Cap</caption><tr><th>Name<th>N<tr><td>alpha<td>1<tr><td colspan=2>wide one<tr><td>b<td>22</table>":
        "Cap\nName   N\nalpha  1\nwide one\nb      22",
    "<style>.x, p.y{display:none}</style><div class=x>no</div><p class=y>no<p class=z>yes": "yes",
    "<div hidden>no</div><div style='display: none'>no</div>a<script>var t='</p>'</script>b": "ab",
    "<div style='visibility:hidden'>no <span style='visibility:visible'>yes</span></div>": "yes",
    "<details><summary>sum</summary>no</details><details open><summary>s</summary>in</details>": "sum\ns\nin",
    "x<pre>  a\n    b</pre>y": "x\n\n  a\n    b\n\ny",
    "<title>no</title><h1>A &amp; B&nbsp;c</h1>t<hr>u": "A & B\xa0c\n\nt\n\nu",
    "<dl><dt>t<dd>d</dl><!-- no --><![CDATA[no]]>e": "t\n  d\n\ne",
    "a < b and c > d <unclosed": "a < b and c > d <unclosed",
    "<td>cell</td> loose </p>x</b>": "cell loose\n\nx",
    "": "", "<div></div>": "", "&lt;p&gt;": "<p>",
    "<table><tr><td>a<table><tr><td>in<td>ner</table></td><td>z</table>": "a        z\n\nin  ner",
}


PAGES |= {  # @ blocks by what holds on a screen, visibility by selectors, the cascade
    "<style>@media print { .nav { display:none } }</style><div class=nav>yes</div>": "yes",
    "<style>@media (max-width:600px) { .n { display:none } } .x{display:none}</style><p class=n>yes<p class=x>no": "yes",
    "<style>@media screen and (min-width:600px) { .n { display:none } }</style><p class=n>no<p>yes": "yes",
    "<style>@media not print { @supports (display:grid) { .n { display:none } } }</style><p class=n>no<p>yes": "yes",
    "<style>@media (400px <= width < 700px), (unheard: of) {.n{display:none}}</style><p class=n>yes": "yes",
    "<style>@keyframes k { from { display:none } } @import 'a{'; /* p{display:none} */ .k{color:red}</style><p>yes": "yes",
    "<style>.m{display:none} @media screen {.m{display:block}}</style><p class=m>yes": "yes",
    "<style>.m{display:none!important} #i{display:block}</style><p class=m id=i>no<p>yes": "yes",
    "<style>.n { color:red; @media print { display:none } .o { display:none } }</style><p class=n>yes": "yes",
    "<style media=print>p{display:none}</style><noscript><style>p{display:none}</style></noscript><p>yes": "yes",
    "<style>.h{visibility:hidden} b{visibility:visible}</style><div class=h>no <b>yes</b></div>": "yes",
    "<style>.h{visibility:hidden}</style><ul><li class=h>no<li>yes</ul><table><tr class=h><td>no<tr><td>a<td class=h>no</table>":
        "- yes\n\na",
}


PAGES |= {  # heads that nothing closes
    f"<head><title>no</title>{start}yes": "yes"
    for start in ("", "\n", "<a>", "<span>", "<font><p>", "<my-app><div>", "<li hidden>no</li>", "<svg>no</svg>", "</br>",
                  "<meta charset=utf-8><script>no</script><noscript><p>no</noscript><template><p>no</template>", "<body>")}


PAGES |= {  # cells across rows, lines in cells, forms and drawings, markers of lists
    "<table><tr><td rowspan=2>AAAA<td>B<tr><td>C</table>": "AAAA  B\n      C",
    "<table><tr><th colspan=2>head<th rowspan=0>z<tr><td>a<td>b<tr><td>c<td>d</table>": "head  z\na  b\nc  d",
    "<table><tr><td>x<ul><li>a<li>b</ul>q<td>r<tr><td>1<td>2</table>": "x    r\n\n- a\n- b\n\nq\n1    2",
    "<table><tr><td>a<br>b<td rowspan=2>p<br>q<br>r<br>s<tr><td>c</table>": "a  p\nb  q\nc  r\n   s",
    "<table><tr><td rowspan=3>t<td>u<tr><td hidden>no<tr><td>w</table>": "t  u\n   w",
    "<table><tr><td><p>one<p>two<td>x</table>": "one  x\n\ntwo",
    "<p>a <select><option>one<option selected>two</select> b": "a two b",
    "<p>a <select><optgroup label=no><option disabled>pick<option>one</optgroup></select> b": "a one b",
    "<select multiple><option>one<option hidden>no<option>two</select>": "one two",
    "<textarea>as\ntyped</textarea><datalist><option>no</datalist>": "as typed",
    "<svg><title>no</title><defs><text>no</text></defs><text>seen</text><text>too</text></svg>": "seen too",
    "<math><mi>x</mi><mo>+</mo><mn>1</mn></math>": "x+1",
    "<ol type=a start=26><li>z<li>aa<li value=-1>m</ol>": "z. z\naa. aa\n-1. m",
    "<ol reversed><li>b<li>a</ol><ol type=I><li value=1994>y<li type=i>z</ol>": "2. b\n1. a\n\nMCMXCIV. y\nmcmxcv. z",
}


@pytest.mark.parametrize("seed", range(25))
def test_spans_lie_where_a_plain_grid_has_them(seed):
    """Every slot of the grid is asked whether it is free; texts are unique and as wide as their columns."""
    draw, html, taken, cells = random.Random(seed), "", {}, {}
    for r in range(draw.randrange(1, 8)):
        html += "<tr>"
        for k in range(draw.randrange(1, 6)):
            across, down = (1, 1) if not k else (draw.choice([1, 1, 2, 3]), draw.choice([1, 1, 2, 3]))
            column = next(c for c in range(100) if (r, c) not in taken)
            name = f"c{len(cells):03d}"
            # as browsers do: only the first slot has to be free
            for i in range(r, r + down):
                for c in range(column, column + across):
                    taken.setdefault((i, c), name)
            cells[name] = (r, column)
            html += f"<td colspan={across} rowspan={down}>{name}"
    lines = html_text.page_text(f"<table>{html}</table>").split("\n")
    told = {c for name, (r, c) in cells.items() if re.search(rf"<td colspan=1 [^>]*>{name}", html)}
    edges = [6 * len([c for c in told if c < column]) + 2 * len([c for c in range(column) if c not in told])
             for column in range(100)]
    for name, (r, column) in cells.items():
        at = lines[r].index(name)
        # a text wider than its columns moves what is right of it; nothing comes before its place
        assert at >= edges[column] and (at == edges[column] or any(
            o != name and cells[o][1] < column and lines[r].find(o) >= 0 for o in cells))


@pytest.mark.parametrize("html", list(PAGES))
def test_page_text(html):
    assert html_text.page_text(html) == PAGES[html]


def test_deep_and_long_pages(spark):
    deep = "<div>" * 30_000 + "deep" + "<p>" * 100
    assert html_text.page_text(deep) == "deep"
    assert html_text.page_text("<b>w</b> " * 100_000) == " ".join(["w"] * 100_000)
    assert html_text.page_text("<li>" * 5_000 + "x").endswith("x")
    rows = [(1, "u", "<p>a"), (1, "u", "<p>a"), (2, None, None), (None, "v", ""), (3, "w", deep)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {"text": F.lit("t"), "visible_text": F.lit("v"), "n_chars": F.lit("n")})
    got = html_text.op2(pages).collect()
    assert sorted((r.text, r.n_chars) for r in got) == [("", 0), ("", 0), ("a", 1), ("a", 1), ("deep", 4)]
    assert html_text.op2(pages.limit(0)).collect() == []
