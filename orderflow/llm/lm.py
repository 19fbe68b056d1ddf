"""Operator 10: a log-bilinear language model, trained with noise-contrastive estimation.

The model predicts a word from the two before it: each context word's vector goes through the
matrix of its place, the sum meets the output vector of every word, and a bias is added.  The
first level tells the ``MODEL_WORDS`` most frequent tokens and one class for all others, the tail.

The tail's words are dealt into classes of about ``CLASS_WORDS``, as many classes as their number
asks for.  In its class, every word seen ``LEAST`` times or more has an output vector and a bias of
its own, trained by noise-contrastive estimation on the first level's sums of all the word's
contexts; rarer words share one vector, and have their smoothed shares of its probability.  A class
has its smoothed share of the tail.  So a word's probability is that of the tail, times its class's
share, times its own in the class, and probabilities add up to one over all words (those never seen
in training count as one word, with its smoothed share).  Vectors of tail words are learnt and used
where their class's tokens meet, and never gathered.  As context, tail words share one vector.

Token counts are gathered from all training documents.  Training passes over all of them once, in
``ROUNDS`` rounds: in each, every partition trains a copy of the model on its documents of the
round, and the copies are averaged, weighted by their tokens.  A minibatch shares its noise words,
so its scores are one matrix product.  Scoring normalises exactly: with two context words the
normaliser of every context is one product of two word-by-word matrices of exponentials.

Counts of frequent words (at most ``FREQUENT``, a stated bound) go to the tasks; those of other
words are joined.

Defined cases: a null text is an empty one and has the end token only; a null doc_id counts as an
empty id and is trained on; repeated rows are scored alike and all counted; without training
tokens the model is one class; an empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import blake2b
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.base import written
from orderflow.llm.words import byte_texts, slices

#: Most frequent tokens that the model tells apart, and those whose counts go to the tasks.
MODEL_WORDS, FREQUENT = 2047, 300_000
#: Vector length, tokens and shared noise words of a minibatch, rounds, step size.
SIZE, BATCH, NOISE, ROUNDS, RATE = 32, 2048, 64, 3, 0.1
#: Count from which a tail word has a vector of its own, words of a class, training tokens of a bundle
#: of classes and least number of bundles, tokens of a class's minibatch, contexts normalised at once.
LEAST, CLASS_WORDS, BUNDLE_TOKENS, BUNDLES, CLASS_BATCH, CONTEXTS = 5, 384, 800_000, 32, 512, 4096
CLASS_RATE = 0.1
#: Words counted together before a task hands their totals on; rows of a matrix averaged together.
HELD_WORDS, BLOCK_ROWS = 1_600_000, 256
#: The end token; no word is empty.
END = b""
OTHER, END_ID = 0, 1

ENCODED = ("row long, doc_id long, held_out boolean, n_tokens long, known long, others long, base double, "
           "other double, ids binary, rare array<binary>")


def words(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of a batch's texts, parted by ASCII white space, and how many each text has."""
    texts = pa.array([x.lower() for x in byte_texts(batch)], pa.large_binary())
    lists = pc.ascii_split_whitespace(texts.view(pa.large_string()))
    found = lists.flatten()
    real = pc.not_equal(pc.binary_length(found), 0)  # white space at an end leaves an empty word there
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)[real.to_numpy(zero_copy_only=False)]
    return found.filter(real).cast(pa.large_binary()), np.bincount(owner, minlength=len(sizes))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its id as text leaves 2 modulo 7."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 7 == 2


def token_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts -> (word, n), pre-aggregated."""
    def summed() -> pa.RecordBatch:
        counts = pa.chunked_array(held, pa.large_binary()).value_counts()
        return pa.RecordBatch.from_arrays([counts.field("values").cast(pa.binary()), counts.field("counts")], names=["word", "n"])

    held: list[pa.Array] = []
    ends = 0
    for batch in slices(batches):
        found, sizes = words(batch)
        held.append(found)
        ends += len(sizes)
        if sum(map(len, held)) >= HELD_WORDS:
            yield summed()
            held.clear()
    if ends:
        yield summed()
        yield pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([ends], pa.int64())], names=["word", "n"])


@dataclass
class Vocabulary:
    """Frequent tokens in order of count, and the totals of all training tokens."""

    words: list[bytes]
    counts: np.ndarray
    total: int
    distinct: int
    own: int  # tokens seen ``LEAST`` times or more

    def __post_init__(self) -> None:
        self.model_words = min(MODEL_WORDS, len(self.words))
        told = self.counts[:self.model_words]
        self.other_total = self.total - int(told.sum())
        self.other_distinct = self.distinct - self.model_words
        self.classes = max(1, -(-(self.own - int((told >= LEAST).sum())) // CLASS_WORDS))
        self.bundles = min(self.classes, max(BUNDLES, -(-self.other_total // BUNDLE_TOKENS)))

    @property
    def base_norm(self) -> float:
        return float(np.log10(self.total + self.distinct + 1))

    @property
    def other_norm(self) -> float:
        return float(np.log10(self.other_total + self.other_distinct + 1))

    def unigram(self) -> np.ndarray:
        """Smoothed shares of the model's classes: all other words, then the told ones."""
        counts = np.append(self.other_total + 1, self.counts[:self.model_words] + 1).astype(float)
        return counts / counts.sum()


def gathered(docs: DataFrame) -> tuple[DataFrame, Vocabulary]:
    """Counts of all training tokens (a written table word, c), and the bounded vocabulary."""
    counts = written(docs.filter(~held_out()).select("text").mapInArrow(token_totals, "word binary, n long")
                     .groupBy("word").agg(F.sum("n").alias("c")), "lm-counts")
    sums = counts.agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("distinct"),
                      F.count(F.when(F.col("c") >= LEAST, True)).alias("own")).first()
    # the frequent words by a threshold of counts, found from a histogram of 64 bins an
    # octave, so that no task gathers candidates for a top list
    bins = counts.groupBy(F.floor(F.log2("c") * 64).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    least, held = 0, 0
    for row in sorted(bins.collect(), key=lambda r: -r["bin"]):
        held += row["n"]
        if held > FREQUENT:
            least = row["bin"] + 1
            break
    top = counts.filter((F.floor(F.log2("c") * 64) >= least) | (F.octet_length("word") == 0))
    found = [(bytes(w), c) for batch in top.toArrow().to_batches()
             for w, c in zip(batch.column("word").to_pylist(), batch.column("c").to_pylist())]
    found.sort(key=lambda x: (x[0] != END, -x[1], x[0]))  # the end first, so that its id is fixed
    return counts, Vocabulary([w for w, _ in found], np.array([c for _, c in found], np.int64),
                              sums["total"] or 0, sums["distinct"], sums["own"])


def parted(items: pa.Array) -> list[bytes]:
    """Byte strings of an array, read at once: one by one, each would be an object of Arrow first."""
    data, ends = b"".join(items.buffers()[2:]), np.frombuffer(items.buffers()[1], np.int64)[items.offset:][:len(items) + 1].tolist()
    return [data[a:b] for a, b in zip(ends, ends[1:])]


def word_hash(word: bytes) -> int:
    """64 bits of a word that has no number; the first is set, so that no number is equal."""
    return int.from_bytes(blake2b(word, digest_size=8).digest(), "little") | 1 << 63


_NUMBERS: dict[str, dict[bytes, int]] = {}


def _numbered(name: str, vocabulary: Broadcast) -> dict[bytes, int]:
    """The worker's word numbers of a vocabulary; only the latest is kept."""
    if name not in _NUMBERS:
        _NUMBERS.clear()
        _NUMBERS[name] = {w: i for i, w in enumerate(vocabulary.value.words)}
    return _NUMBERS[name]


def encoded(name: str, vocabulary: Broadcast):
    """``mapInArrow`` function: (row, doc_id, held_out, text) -> ENCODED."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, known = _numbered(name, vocabulary), vocabulary.value
        weight = np.log10(np.append(known.counts, 0) + 1.0)  # the last: words that are not frequent
        for batch in slices(batches):
            found, sizes = words(batch)
            # each distinct word is looked up once; the last one is the end token, after each text's words
            coded = found.dictionary_encode()
            distinct = pa.chunked_array([coded.dictionary, pa.array([END], pa.large_binary())]).combine_chunks()
            own = np.fromiter(map(numbers.get, parted(distinct), repeat(-1)), np.int64, len(distinct))
            code = np.insert(coded.indices.to_numpy(), np.cumsum(sizes), len(distinct) - 1)
            number = own[code]
            sizes = sizes + 1
            ends = np.cumsum(sizes)
            told = (number >= 0) & (number < known.model_words)
            ids = (number + 1).astype("<u4")  # 0: a word without a number
            owner = np.repeat(np.arange(len(sizes)), sizes)

            def sums(values: np.ndarray) -> np.ndarray:
                return np.bincount(owner, weights=values, minlength=len(sizes))

            logs = weight[number]
            unnumbered = np.flatnonzero(number < 0)
            cuts = np.searchsorted(unnumbered, np.append(0, ends))
            rare = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), distinct.take(pa.array(code[unnumbered])).cast(pa.binary()))
            starts = (ends - sizes).tolist()
            yield pa.RecordBatch.from_arrays([
                batch.column("row"), batch.column("doc_id"), batch.column("held_out"), pa.array(sizes, pa.int64()),
                pa.array(sums(number >= 0).astype(np.int64)), pa.array(sums(~told).astype(np.int64)),
                pa.array(sums(np.where(number >= 0, logs, 0.0))),
                pa.array(sums(np.where((number >= 0) & ~told, logs, 0.0))),
                pa.array([ids[a:b].tobytes() for a, b in zip(starts, ends.tolist())], pa.binary()),
                rare],
                names=["row", "doc_id", "held_out", "n_tokens", "known", "others", "base", "other", "ids", "rare"])
    return run


def first_level(ids: Iterable[bytes], model_words: int) -> list[np.ndarray]:
    """The model's classes of texts' ids."""
    found = (np.frombuffer(x, "<u4").astype(np.int64) for x in ids)
    return [np.where(x <= model_words, x, OTHER) for x in found]


@dataclass
class LogBilinear:
    """Parameters: input vectors, a matrix for each context place, output vectors and biases."""

    inputs: np.ndarray
    places: np.ndarray
    outputs: np.ndarray
    bias: np.ndarray

    @classmethod
    def fresh(cls, unigram: np.ndarray, size: int = SIZE, seed: int = 5) -> LogBilinear:
        """Small vectors and the unigram's biases: the unigram model to start with."""
        rng = np.random.default_rng(seed)
        n = len(unigram)
        return cls(rng.normal(0, 0.1, (n, size)).astype(np.float32),
                   np.stack([np.eye(size), 0.5 * np.eye(size)]).astype(np.float32),
                   rng.normal(0, 0.1, (n, size)).astype(np.float32), np.log(unigram).astype(np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.inputs, self.places, self.outputs, self.bias]

    def copy(self) -> LogBilinear:
        return LogBilinear(*(p.copy() for p in self.parts()))

    def turned(self) -> tuple[np.ndarray, np.ndarray]:
        """Input vectors through the matrices of both places."""
        return self.inputs @ self.places[0], self.inputs @ self.places[1]

    def log_normalised(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores of (previous, word) and (one before, word), and log normalisers of both contexts."""
        near = (self.inputs @ self.places[0]) @ self.outputs.T
        far = (self.inputs @ self.places[1]) @ self.outputs.T + self.bias
        top_near, top_far = near.max(axis=1), far.max(axis=1)
        sums = np.exp(near - top_near[:, None]) @ np.exp(far - top_far[:, None]).T
        return near, far, np.log(np.maximum(sums, 1e-30)) + top_near[:, None] + top_far[None, :]


def added_rows(out: np.ndarray, index: np.ndarray, rows: np.ndarray) -> None:
    """``out[index] += rows`` with repeated indexes."""
    # 16-bit numbers are sorted by their digits
    order = np.argsort(index.astype(np.uint16) if len(out) <= 1 << 16 else index, kind="stable")
    index = index[order]
    starts = np.flatnonzero(np.append(True, index[1:] != index[:-1]))
    out[index[starts]] += np.add.reduceat(rows[order], starts, axis=0)


def added_few(out: np.ndarray, index: np.ndarray, rows: np.ndarray) -> None:
    """``out[index] += rows`` with repeated indexes, for few rows; number by number, which numpy adds faster."""
    width = out.shape[1]
    np.add.at(out.reshape(-1), np.add.outer(index * width, np.arange(width)).ravel(), rows.ravel())


def doubts(scores: np.ndarray) -> np.ndarray:
    """Logistic function of scores given with the other sign, in their place."""
    np.clip(scores, -30, 30, out=scores)
    np.exp(scores, out=scores)
    scores += 1
    return np.divide(1, scores, out=scores)


class Trainer:
    """Noise-contrastive steps on minibatches, with per-parameter step sizes."""

    def __init__(self, model: LogBilinear, unigram: np.ndarray, seed: int):
        self.model, self.rng = model, np.random.default_rng(seed)
        self.shares = np.cumsum(unigram)
        self.log_noise = (np.log(unigram) + np.log(NOISE)).astype(np.float32)
        self.squares = [np.full_like(p, 1e-2) for p in model.parts()]
        self.grads = [np.zeros_like(p) for p in model.parts()]  # zero between steps

    def step(self, word: np.ndarray, near: np.ndarray, far: np.ndarray) -> None:
        m, grads = self.model, self.grads
        noise = np.minimum(np.searchsorted(self.shares, self.rng.random(NOISE) * self.shares[-1]), len(self.shares) - 1)
        a, b = m.inputs.take(near, axis=0), m.inputs.take(far, axis=0)
        hidden = a @ m.places[0]
        hidden += b @ m.places[1]
        target, drawn = m.outputs.take(word, axis=0), m.outputs[noise]
        score = np.einsum("ij,ij->i", hidden, target) + m.bias[word] - self.log_noise[word]
        scores = hidden @ -drawn.T
        scores -= m.bias[noise] - self.log_noise[noise]
        wrong = -1 / (1 + np.exp(np.clip(score, -30, 30)))           # data taken for noise
        doubt = doubts(scores)                                       # noise taken for data
        back = np.multiply(wrong[:, None], target, out=target)
        back += doubt @ drawn
        added_rows(grads[0], near, back @ m.places[0].T)
        added_rows(grads[0], far, back @ m.places[1].T)
        grads[1][0], grads[1][1] = a.T @ back, b.T @ back
        added_rows(grads[2], word, wrong[:, None] * hidden)
        added_few(grads[2], noise, doubt.T @ hidden)
        grads[3] += np.bincount(word, weights=wrong, minlength=len(m.bias)).astype(np.float32)
        np.add.at(grads[3], noise, doubt.sum(axis=0))
        # a step moves only the rows that it met
        for part, square, grad, met in zip(m.parts(), self.squares, grads, ((near, far), None, (word, noise), None)):
            if met is None:
                rows = slice(None)
            else:
                some = np.zeros(len(part), bool)
                for index in met:
                    some[index] = True
                rows = np.flatnonzero(some)
            slope, sums = grad[rows] / len(word) ** 0.5, square[rows]
            sums += slope * slope
            square[rows] = sums
            slope *= RATE
            slope /= np.sqrt(sums)
            part[rows] -= slope
            grad[rows] = 0


def contexts(ids: list[np.ndarray], start: int = END_ID) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, previous word and the one before, of every token; texts begin after end tokens."""
    if not ids:
        return (np.zeros(0, np.int64),) * 3
    pad = np.full(2, start, np.int64)
    flat = np.concatenate([x for i in ids for x in (pad, i)])
    sizes = np.array([len(i) + 2 for i in ids])
    keep = np.ones(len(flat), bool)
    starts = np.cumsum(sizes) - sizes
    keep[starts] = keep[starts + 1] = False
    at = np.flatnonzero(keep)
    return flat[at], flat[at - 1], flat[at - 2]


COPY = "block int, tokens long, data binary"


def _blocks(model: LogBilinear) -> list[np.ndarray]:
    """The model's parameters as one row of numbers, in blocks."""
    flat = np.concatenate([p.ravel() for p in model.parts()])
    step = BLOCK_ROWS * SIZE
    return [flat[i:i + step] for i in range(0, len(flat), step)]


def _assembled(blocks: list[np.ndarray], like: LogBilinear) -> LogBilinear:
    flat, out, at = np.concatenate(blocks).astype(np.float32), [], 0
    for part in like.parts():
        out.append(flat[at:at + part.size].reshape(part.shape))
        at += part.size
    return LogBilinear(*out)


def trained_copies(model: Broadcast, unigram: Broadcast, number: int):
    """``mapInArrow`` function: encoded texts of a partition -> its trained copy, in blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        own = model.value.copy()
        trainer = Trainer(own, unigram.value, 1000 * TaskContext.get().partitionId() + number)
        seen = 0
        for batch in batches:
            ids = first_level(batch.column("ids").to_pylist(), len(unigram.value) - 1)
            word, near, far = contexts(ids)
            order = trainer.rng.permutation(len(word))
            for i in range(0, len(word), BATCH):
                at = order[i:i + BATCH]
                trainer.step(word[at], near[at], far[at])
            seen += len(word)
        if seen:
            parts = _blocks(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(parts)), pa.int32()), pa.array([seen] * len(parts), pa.int64()),
                 pa.array([p.tobytes() for p in parts], pa.binary())], names=["block", "tokens", "data"])
    return run


def averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies of blocks -> their weighted sums in this partition (one row a block, of bounded size)."""
    sums: dict[int, np.ndarray] = {}
    weights: dict[int, int] = {}
    for batch in batches:
        for block, n, data in zip(*(c.to_pylist() for c in batch.columns)):
            row = np.frombuffer(data, np.float32).astype(np.float64) * n
            sums[block] = sums[block] + row if block in sums else row
            weights[block] = weights.get(block, 0) + n
    found = sorted(sums)
    yield pa.RecordBatch.from_arrays(
        [pa.array(found, pa.int32()), pa.array([weights[b] for b in found], pa.int64()),
         pa.array([(sums[b] / weights[b]).astype(np.float32).tobytes() for b in found], pa.binary())],
        names=["block", "tokens", "data"])


def train(texts: DataFrame, vocabulary: Vocabulary) -> LogBilinear:
    """The model after ``ROUNDS`` rounds over the training rows of ``texts`` (ENCODED, written)."""
    spark = texts.sparkSession
    unigram = vocabulary.unigram()
    shared = spark.sparkContext.broadcast(unigram)
    model = LogBilinear.fresh(unigram)
    if len(unigram) < 3:
        return model
    rows = texts.filter("not held_out").select("row", "ids")
    for number in range(ROUNDS):
        part = rows.filter(F.pmod(F.xxhash64("row"), F.lit(ROUNDS)) == number).select("ids")
        copies = part.mapInArrow(trained_copies(spark.sparkContext.broadcast(model), shared, number), COPY)
        # a row for each block of the model: bounded by the vocabulary and the vector length
        means = copies.repartition("block").mapInArrow(averaged, COPY).orderBy("block").collect()
        if means:
            model = _assembled([np.frombuffer(r["data"], np.float32) for r in means], model)
    return model


_TABLES: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def scored(name: str, model: Broadcast):
    """``mapInArrow`` function: (row, ids) -> (row, told), the natural log probability by the model."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _TABLES:
            _TABLES.clear()
            _TABLES[name] = model.value.log_normalised()
        near_scores, far_scores, norms = _TABLES[name]
        for batch in slices(batches, "ids"):
            ids = first_level(batch.column("ids").to_pylist(), len(norms) - 1)
            word, near, far = contexts(ids, min(END_ID, len(norms) - 1))
            logs = (near_scores[near, word] + far_scores[far, word] - norms[near, far]).astype(np.float64)
            owner = np.repeat(np.arange(len(ids)), [len(i) for i in ids])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(np.bincount(owner, weights=logs, minlength=len(ids)))],
                names=["row", "told"])
    return run


TAIL = np.dtype([("row", "<i8"), ("key", "<u8"), ("near", "<u2"), ("far", "<u2"), ("held", "u1")])


def packed_tokens(tokens: np.ndarray) -> bytes:
    """Records of ``TAIL``, byte by byte of all records, compressed."""
    planes = np.ascontiguousarray(tokens.view(np.uint8).reshape(len(tokens), TAIL.itemsize).T)
    return len(tokens).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpacked_tokens(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], n * TAIL.itemsize, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(TAIL.itemsize, n).T).view(TAIL).ravel()


def tail_tokens(model_words: int, classes: int, bundles: int):
    """``mapInArrow`` function: (row, held_out, ids, rare) -> (bundle, data), the tail's tokens with their contexts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def handed() -> pa.RecordBatch:
            tokens = np.concatenate(held)
            bundle = (tokens["key"] % classes % bundles).astype(np.int64)
            tokens = tokens[np.argsort(bundle, kind="stable")]
            sizes = np.bincount(bundle, minlength=bundles)
            found, ends = np.flatnonzero(sizes), np.cumsum(sizes)
            return pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int32()), pa.array([packed_tokens(tokens[ends[b] - sizes[b]:ends[b]]) for b in found],
                                                       pa.binary())], names=["bundle", "data"])

        held: list[np.ndarray] = []
        for batch in slices(batches, "ids"):
            data = batch.column("ids").to_pylist()
            ids = first_level(data, model_words)
            word, near, far = contexts(ids)
            at = np.flatnonzero(word == OTHER)
            owner = np.repeat(np.arange(len(ids)), [len(i) for i in ids])[at]
            tokens = np.empty(len(at), TAIL)
            tokens["row"] = batch.column("row").to_numpy()[owner]
            tokens["held"] = batch.column("held_out").to_numpy(zero_copy_only=False)[owner]
            tokens["near"], tokens["far"] = near[at], far[at]
            key = np.frombuffer(b"".join(data), "<u4")[at].astype("<u8")  # a word's number, or else its hash
            key[key == 0] = [word_hash(w) for x in batch.column("rare").to_pylist() for w in x]
            tokens["key"] = key
            held.append(tokens)
            if sum(map(len, held)) >= 500_000:
                yield handed()
                held.clear()
        if sum(map(len, held)):
            yield handed()
    return run


def class_outputs(hidden: np.ndarray, word: np.ndarray, shares: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Output vectors and biases of a class's words, trained on (hidden, word) by noise-contrastive estimation."""
    rng = np.random.default_rng(seed)
    outputs, bias = np.zeros((len(shares), hidden.shape[1]), np.float32), np.log(shares).astype(np.float32)
    squares = [np.full_like(outputs, 1e-2), np.full_like(bias, 1e-2)]
    drawn_from, log_noise = np.cumsum(shares), (np.log(shares) + np.log(NOISE)).astype(np.float32)
    for _ in range(ROUNDS):
        order = rng.permutation(len(word))
        for i in range(0, len(word), CLASS_BATCH):
            at = order[i:i + CLASS_BATCH]
            h, w = hidden.take(at, axis=0), word[at]
            noise = np.minimum(np.searchsorted(drawn_from, rng.random(NOISE) * drawn_from[-1]), len(shares) - 1)
            score = np.einsum("ij,ij->i", h, outputs.take(w, axis=0)) + bias[w] - log_noise[w]
            scores = h @ -outputs[noise].T
            scores -= bias[noise] - log_noise[noise]
            wrong = -1 / (1 + np.exp(np.clip(score, -30, 30)))
            doubt = doubts(scores)
            grads = [np.zeros_like(outputs), np.bincount(w, weights=wrong, minlength=len(bias)).astype(np.float32)]
            added_rows(grads[0], w, wrong[:, None] * h)
            added_few(grads[0], noise, doubt.T @ h)
            np.add.at(grads[1], noise, doubt.sum(axis=0))
            for part, square, grad in zip((outputs, bias), squares, grads):
                grad /= len(at) ** 0.5
                square += grad * grad
                part -= CLASS_RATE * grad / np.sqrt(square)
    return outputs, bias


def class_normalisers(first: np.ndarray, second: np.ndarray, near: np.ndarray, far: np.ndarray, outputs: np.ndarray,
                      bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log normalisers of the distinct pairs of context words, and the pair of every token.

    exp(a + b) = exp(a) exp(b): the exponentials are taken once for each context word and place, and
    a pair's normaliser is the product of two of their rows.
    """
    pairs, pair = np.unique(first.astype(np.int64) << 16 | second, return_inverse=True)
    rows, tops, numbers = [], [], []
    for ids, vectors, shift in ((pairs >> 16, near, 0), (pairs & 0xFFFF, far, bias)):
        used, number = np.unique(ids, return_inverse=True)
        part = vectors[used] @ outputs.T + shift
        top = part.max(axis=1)
        part -= top[:, None]
        rows.append(np.exp(part, out=part))
        tops.append(top)
        numbers.append(number)
    norms = np.empty(len(pairs), np.float32)
    for i in range(0, len(pairs), CONTEXTS):
        a, b = (number[i:i + CONTEXTS] for number in numbers)
        norms[i:i + CONTEXTS] = np.einsum("ij,ij->i", rows[0][a], rows[1][b])
    return np.log(np.maximum(norms, 1e-30)) + tops[0][numbers[0]] + tops[1][numbers[1]], pair


def class_gains(tokens: np.ndarray, model: LogBilinear, seed: int, turned: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Log of each token's probability in its class over its smoothed share of it; 0 for words not seen in training."""
    keys, word = np.unique(tokens["key"], return_inverse=True)
    learnt = tokens["held"] == 0
    counts = np.bincount(word[learnt], minlength=len(keys))
    own, rarer = counts >= LEAST, (counts > 0) & (counts < LEAST)
    # slots: the words with vectors of their own, then all rarer ones
    slots = np.append(counts[own] + 1.0, [(counts[rarer] + 1.0).sum()] if rarer.any() else [])
    if len(slots) < 2:
        return np.zeros(len(tokens))
    shares = slots / slots.sum()
    slot = np.where(own, np.cumsum(own) - 1, int(own.sum()))[word]
    near, far = turned or model.turned()
    hidden = near[tokens["near"]] + far[tokens["far"]]
    outputs, bias = class_outputs(hidden[learnt], slot[learnt], shares, seed)
    norms, pair = class_normalisers(tokens["near"], tokens["far"], near, far, outputs, bias)
    gains = np.einsum("ij,ij->i", hidden, outputs[np.minimum(slot, len(slots) - 1)]) - norms[pair]
    gains += (bias - np.log(shares))[np.minimum(slot, len(slots) - 1)]
    return np.where(counts[word] > 0, gains, 0.0)


GAINS = "row long, gain double"


def bundle_gains(classes: int, model: Broadcast):
    """``applyInArrow`` function: a bundle's tokens -> the sum of gains of every row that has some of them."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        tokens = np.concatenate([unpacked_tokens(x) for x in table.column("data").to_pylist()])
        tokens = tokens[np.argsort(tokens["row"], kind="stable")]  # the same order, however the rows came
        label = tokens["key"] % classes
        order = np.argsort(label, kind="stable")
        gains, turned = np.zeros(len(tokens)), model.value.turned()
        for at in np.split(order, np.flatnonzero(np.diff(label[order])) + 1):
            gains[at] = class_gains(tokens[at], model.value, int(label[at[0]]), turned)
        rows, owner = np.unique(tokens["row"], return_inverse=True)
        return pa.table({"row": rows, "gain": np.bincount(owner, weights=gains)})
    return run


def tail_gains(texts: DataFrame, vocabulary: Vocabulary, model: LogBilinear) -> DataFrame:
    """(row, gain): what the vectors of the tail's words add to the natural log probability of a row."""
    shared = texts.sparkSession.sparkContext.broadcast(model)
    dealt = (texts.filter("others > 0").select("row", "held_out", "ids", "rare")
             .mapInArrow(tail_tokens(vocabulary.model_words, vocabulary.classes, vocabulary.bundles), "bundle int, data binary"))
    return (dealt.groupBy("bundle").applyInArrow(bundle_gains(vocabulary.classes, shared), GAINS)
            .groupBy("row").agg(F.sum("gain").alias("gain")))


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``."""
    spark = docs.sparkSession
    counts, vocabulary = gathered(docs)
    name, shared = uuid.uuid4().hex, spark.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       held_out().alias("held_out"), "text")
    texts = written(rows.mapInArrow(encoded(name, shared), ENCODED), "lm-texts")
    rare = (texts.select("row", F.explode("rare").alias("word")).groupBy("row", "word")
            .agg(F.count(F.lit(1)).alias("n")).join(counts, "word", "left").groupBy("row")
            .agg(F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("rare_log"),
                 F.sum(F.when(F.col("c") > 0, F.col("n"))).alias("rare_known")))
    model = train(texts, vocabulary)
    told = texts.select("row", "ids").mapInArrow(scored(name, spark.sparkContext.broadcast(model)),
                                                 "row long, told double")
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    gain = tail_gains(texts, vocabulary, model)
    parts = texts.drop("ids", "rare").join(told, "row").join(rare, "row", "left").join(gain, "row", "left")
    return (parts.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        (F.col("base") + rare_log - F.col("n_tokens") * F.lit(vocabulary.base_norm)).alias("base_score"),
        ((F.col("told") + F.coalesce("gain", F.lit(0.0))) * F.lit(float(np.log10(np.e)))
         + F.col("other") + rare_log
         - F.col("others") * F.lit(vocabulary.other_norm)).alias("score")))
