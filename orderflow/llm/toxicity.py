"""Operator 3: toxicity as expected severity, by cumulative-link ordinal regression.

Grades: 0 for a row labelled clean; a row labelled toxic is graded by how many marker words it
has (words that mark the toxic rows of the sample): 1 below ``SEVERE`` occurrences, 2 from there
on.  Where no word marks them (none is both likely enough there and in a twentieth of them, as with
hundreds of different insults) no row has grade 2, the upper threshold is out of reach and the
severity stays within 1.  P(grade > k) = logistic(w.x - threshold_k) with one weight vector for all thresholds and
ordered thresholds; x are 1 + log counts of words and of words that begin alike (the first four
and five bytes, for insults that take endings).  An L1 penalty picks the few words
that tell, and a second fit on those words weighs them with hardly any penalty.  The severity of a text is its expected grade; it is toxic where grade 1
or more is likelier than not.

The model is fitted on at most ``SAMPLE`` labelled rows (a documented bound; the rows with the
smallest hashes); all documents are scored, whole.

Defined cases: a null or wordless text is scored by the thresholds alone; labels without a
document, with a null label or a null id are left out, and of an id labelled both ways the toxic
label counts; of an id with several texts the one with the smallest hash trains; without labels of both kinds every text is clean (severity 0); repeated rows score
alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.base import sampled, written
from orderflow.llm.words import byte_texts, slices, words

#: Most labelled rows to fit on, most words to fit (those that tell most by the likelihood
#: ratio), fewest sampled rows that have such a word.
SAMPLE, VOCABULARY, FEWEST_ROWS = 20_000, 2_000, 5
#: A word marks toxic rows if it is this much likelier there, in log odds; occurrences for grade 2.
MARKER, SEVERE = 4.0, 4
#: The L1 penalty is this times sqrt(log words / rows) in the first fit, a fiftieth in the second.
PENALTY, ROUNDS = 0.1, 400


def features(text: bytes, known: dict | None = None) -> Counter:
    """How often each word (``word$``) and word beginning (``begi*``) comes; only the known ones, if given."""
    out: Counter = Counter()
    for word, n in Counter(words(text)).items():
        for key in (word + b"$", word[:4] + b"*", word[:5] + b"*") if len(word) > 4 else (word + b"$",):
            if known is None or key in known:
                out[key] += n
    return out


@dataclass
class OrdinalModel:
    """Weights of the words and ordered thresholds."""

    weights: dict[bytes, float]
    thresholds: list[float]

    def exceeds(self, text: bytes) -> list[float]:
        """P(grade > k) for each threshold."""
        if not self.thresholds:
            return [0.0, 0.0]
        counts = features(text, self.weights)
        z = sum(self.weights[w] * (1 + np.log(n)) for w, n in counts.items())
        return [float(1 / (1 + np.exp(t - z))) for t in self.thresholds]


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit_ordinal(index: np.ndarray, value: np.ndarray, row: np.ndarray, grade: np.ndarray, width: int,
                penalty: float, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by accelerated proximal gradient; sparse rows as (row, index, value).

    Thresholds are t_0 and t_0 + exp(gaps), so they stay ordered.
    """
    n, levels = len(grade), int(grade.max())
    w, share = np.zeros(width), [(grade > k).mean() for k in range(levels)]
    starts = np.array([np.log((1 - p + 1e-3) / (p + 1e-3)) for p in share])
    theta = np.concatenate([starts[:1], np.log(np.maximum(np.diff(starts), 1e-2))])
    low, high = np.minimum(grade, levels) - 1, grade
    v = np.ones(width)  # largest eigenvalue of X'X / n by power iteration, for the step
    for _ in range(20):
        v = v / max(1e-12, np.linalg.norm(v))
        v = np.bincount(index, weights=value * np.bincount(row, weights=value * v[index], minlength=n)[row],
                        minlength=width) / n
    step = 2.0 / max(1e-9, np.linalg.norm(v))
    ahead, momentum = w.copy(), 1.0
    for _ in range(rounds):
        cut = np.cumsum(np.concatenate([theta[:1], np.exp(theta[1:])]))
        z = np.bincount(row, weights=value * ahead[index], minlength=n)
        above_low = np.where(low >= 0, logistic(z - cut[np.maximum(low, 0)]), 1.0)
        above_high = np.where(high < levels, logistic(z - cut[np.minimum(high, levels - 1)]), 0.0)
        p = np.maximum(above_low - above_high, 1e-12)
        d_low, d_high = above_low * (1 - above_low) / p, above_high * (1 - above_high) / p
        slope = (d_low - d_high) / n
        gradient = np.bincount(index, weights=-value * slope[row], minlength=width)
        new = ahead - step * gradient
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        by_cut = np.zeros(levels)
        np.add.at(by_cut, low[low >= 0], d_low[low >= 0] / n)
        np.add.at(by_cut, high[high < levels], -d_high[high < levels] / n)
        tail = np.cumsum(by_cut[::-1])[::-1]
        theta = theta - 1.0 * np.concatenate([tail[:1], tail[1:] * np.exp(theta[1:])])
        following = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        ahead = new + (momentum - 1) / following * (new - w)
        w, momentum = new, following
    return w, np.cumsum(np.concatenate([theta[:1], np.exp(theta[1:])]))


def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled rows -> (number, toxic, words, counts); ``number`` tells rows apart in the sample."""
    for batch in slices(batches):
        found = [features(x) for x in byte_texts(batch)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("toxic"),
             pa.array([list(c) for c in found], pa.list_(pa.binary())),
             pa.array([list(c.values()) for c in found], pa.list_(pa.int32()))],
            names=["doc_id", "toxic", "words", "counts"])


def chosen_features(vocabulary: dict[bytes, int]):
    """(words, counts) of a row -> the vocabulary's numbers and counts, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, counts = [], []
            for found, many in zip(batch.column("words").to_pylist(), batch.column("counts").to_pylist()):
                pairs = [(vocabulary[w], n) for w, n in zip(found, many) if w in vocabulary]
                numbers.append(np.array([p[0] for p in pairs], "<i4").tobytes())
                counts.append(np.array([p[1] for p in pairs], "<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(numbers, pa.binary()),
                                              pa.array(counts, pa.binary())], names=["toxic", "numbers", "counts"])
    return run


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> OrdinalModel:
    """The model of at most ``sample`` labelled documents."""
    sound = written(labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id")
                    .agg(F.max(F.col("toxic").cast("int")).alias("toxic")), "toxic-labels")
    chosen = sampled(sound, F.col("doc_id"), sample)  # the documented bound
    # of several texts of one id the one with the smallest hash trains
    one = F.min_by(F.struct("toxic", "text"), F.struct(F.xxhash64("text"), "text")).alias("one")
    rows = written(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
                   .groupBy("doc_id").agg(one).select("doc_id", "one.toxic", "one.text")
                   .mapInArrow(word_counts, "doc_id long, toxic int, words array<binary>, counts array<int>"),
                   "toxic-sample")
    kinds = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean_rows, toxic_rows = kinds.get(0, 0), sum(n for k, n in kinds.items() if k)
    if not clean_rows or not toxic_rows:
        return OrdinalModel({}, [])
    words_found = (rows.select("toxic", F.explode("words").alias("word")).groupBy("word")
                   .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("toxic") != 0).alias("toxic"))
                   .filter(F.col("n") >= FEWEST_ROWS))
    n, t, share = F.col("n"), F.col("toxic"), toxic_rows / (toxic_rows + clean_rows)
    ratio = t * F.log((t + 0.5) / (n * share + 0.5)) + (n - t) * F.log((n - t + 0.5) / (n * (1 - share) + 0.5))
    found = words_found.orderBy(ratio.desc(), "word").limit(VOCABULARY).collect()
    vocabulary = {bytes(r["word"]): i for i, r in enumerate(found)}
    if not vocabulary:
        return OrdinalModel({}, [])
    toxic = np.array([r["toxic"] for r in found], float)
    clean = np.array([r["n"] for r in found], float) - toxic
    odds = np.log((toxic + 0.5) / (toxic_rows + 1)) - np.log((clean + 0.5) / (clean_rows + 1))
    marks = (odds >= MARKER) & (toxic >= 0.05 * toxic_rows)
    featured = rows.mapInArrow(chosen_features(vocabulary), "toxic int, numbers binary, counts binary").collect()
    numbers = [np.frombuffer(r["numbers"], "<i4") for r in featured]
    counts = [np.frombuffer(r["counts"], "<i4") for r in featured]
    grade = np.array([0 if not r["toxic"] else 2 if c[marks[i]].sum() >= SEVERE else 1
                      for r, i, c in zip(featured, numbers, counts)])
    row = np.repeat(np.arange(len(featured)), [len(i) for i in numbers])
    index, value = np.concatenate(numbers), 1 + np.log(np.concatenate(counts))
    penalty = PENALTY * np.sqrt(np.log(1 + len(vocabulary)) / len(grade))
    weights, _ = fit_ordinal(index, value, row, grade, len(vocabulary), penalty)
    telling = weights[index] != 0
    weights, thresholds = fit_ordinal(index[telling], value[telling], row[telling], grade, len(vocabulary),
                                      penalty / 50, 5 * ROUNDS)
    kept = {w: float(weights[i]) for w, i in vocabulary.items() if weights[i]}
    cuts = [float(t) for t in thresholds]
    return OrdinalModel(kept, cuts + [50.0] * (2 - len(cuts)))


def scored_batches(model: OrdinalModel, keep: list[str]):
    """``mapInArrow`` function: adds p_toxic and severity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            over = [model.exceeds(x) for x in byte_texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array([x[0] for x in over], pa.float64()),
                 pa.array([sum(x) for x in over], pa.float64())], names=[*keep, "p_toxic", "severity"])
    return run


def severity(docs: DataFrame, model: OrdinalModel, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with p_toxic (grade 1 or more) and severity (expected grade)."""
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([*(f"`{c}` {fields[c]}" for c in keep), "p_toxic double, severity double"])
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(scored_batches(model, keep), schema)


def acceptable_batches(model: OrdinalModel):
    """``mapInArrow`` function: the rows that are not toxic."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array([model.exceeds(x)[0] < 0.5 for x in byte_texts(batch)], pa.bool_()))
    return run


def without_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with all their columns."""
    return docs.mapInArrow(acceptable_batches(fit(docs, labels, sample)), docs.schema)


def op3(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, p_toxic, severity and toxic of every document row."""
    return severity(docs, fit(docs, labels), ["doc_id"]).withColumn("toxic", F.col("p_toxic") >= 0.5)
