"""Operator 9: personal data, by rules and a semi-Markov conditional random field.

The base finds e-mail addresses, IP addresses, card numbers and phone numbers by rule.  A
semi-Markov conditional random field adds spans: a text's stretches around digits and at-signs are
cut into tokens, every run of up to ``LONGEST`` tokens that begins and ends at a visible token is a
candidate segment, features of the whole segment (shape, digit count, separators, the words before
and after) score it for each kind, and dynamic programming over segments of bounded length picks
boundaries and kinds together.  Base spans stay; the model's spans that touch none of them join.

The model is trained on at most ``EXAMPLES`` stretches of at most ``LONGEST_EXAMPLE`` characters (those
with the smallest hashes) from at most ``SAMPLE`` documents that have digits or at-signs (likewise);
these are documented bounds, and parameters of ``fit``, of training alone: all texts are searched
whole.  It learns the likelihood of the base spans in them, with features that do not contain the
rules' checks (checksum, value ranges, plus sign), so that spans of the same build but outside the
rules can score.

Defined cases: a null text is an empty one; positions are code points, ends exclusive; repeated
rows give equal results; very long texts are read whole, stretch by stretch; without anything to
train on the model adds nothing; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.base import sampled, written
from orderflow.llm.words import slices

KINDS = ("email", "ip", "card", "phone")
#: Most documents and most of their stretches to train on, passes, step size, penalty.
SAMPLE, EXAMPLES, PASSES, RATE, PENALTY = 1_500, 3_000, 6, 0.15, 1e-4
#: Longest stretch to train on, in characters (scoring has no such bound).
LONGEST_EXAMPLE = 4_000
#: Longest segment in tokens; characters around a digit or at-sign that make a stretch.
LONGEST, AROUND = 14, 24
#: A segment joins the result where its probability given the text is at least this.
SURE = 0.9

_EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses: each at-sign's domain, and the local part's run before it."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _EMAIL_LOCAL:
            start -= 1
        match = _EMAIL_DOMAIN.match(text, at) if start < at else None
        if match:
            out.append((start, match.end()))
            free = match.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the rules' matches, by kind as listed, then start."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not _DIGITS.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if len(m.group()) >= 16:
            digits = re.sub(r"[^0-9]", "", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGITS.findall(m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|\s+|[^\sA-Za-z0-9]")
_TRIGGER = re.compile(r"[0-9@]")


def stretches(text: str) -> Iterator[tuple[int, int]]:
    """The parts of a text that lie near a digit or at-sign, widened to white space."""
    start = end = -1
    for m in _TRIGGER.finditer(text):
        at = m.start()
        if start >= 0 and at - AROUND <= end:
            end = at + AROUND
            continue
        if start >= 0:
            yield start, _widened(text, end)
        start, end = max(0, at - AROUND), at + AROUND
    if start >= 0:
        yield start, _widened(text, end)


def _widened(text: str, end: int) -> int:
    """The next white space after ``end``, within as many characters again."""
    end = min(end, len(text))
    limit = min(len(text), end + AROUND)
    while end < limit and not text[end].isspace():
        end += 1
    return end


def segments(text: str, start: int, end: int) -> tuple[list[tuple[int, int]], list[tuple[int, int, list[str]]]]:
    """Tokens of a stretch, and the candidate segments (first token, token after, features)."""
    tokens = [m.span() for m in _TOKEN.finditer(text, start, end)]
    visible = [not text[a].isspace() for a, _ in tokens]
    digits = [0]
    ats = [0]
    for a, b in tokens:
        digits.append(digits[-1] + (b - a if text[a] in "0123456789" else 0))
        ats.append(ats[-1] + (text[a] == "@"))
    found = []
    for i, (a, _) in enumerate(tokens):
        if not visible[i]:
            continue
        for j in range(i + 1, min(len(tokens), i + LONGEST) + 1):
            if visible[j - 1] and (digits[j] - digits[i] >= 4 or ats[j] > ats[i]):
                found.append((i, j, features(text, a, tokens[j - 1][1], digits[j] - digits[i])))
    return tokens, found


def features(text: str, a: int, b: int, digits: int) -> list[str]:
    """Features of the whole span [a, b) and of what stands at its borders."""
    span = text[a:b]
    shape = re.sub(r"[A-Za-z]+", "a", re.sub(r"[0-9]+", lambda m: f"{min(len(m.group()), 20)}d", span))
    loose = re.sub(r"[0-9]+d", "d", shape)
    before = text[a - 1:a]
    after = text[b:b + 1]
    edge = lambda c: "start" if not c else "blank" if c.isspace() else "a" if c.isalpha() else "d" if c.isdigit() else c
    groups = re.findall(r"[0-9]+", span)
    return ["all", f"shape={shape}", f"loose={loose}", f"digits={min(digits, 24)}", f"groups={min(len(groups), 6)}",
            f"before={edge(before)}", f"after={edge(after)}", f"first={edge(span[0])}", f"last={edge(span[-1])}",
            f"at={span.count('@')}", f"dots={min(span.count('.'), 5)}", f"blanks={min(len(span.split()), 5)}",
            f"marks={''.join(sorted(set(re.sub('[A-Za-z0-9]', '', span))))[:6]}"]


class SemiMarkov:
    """Weights of (kind, feature); a stretch's score is the sum of its segments' scores."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None):
        self.weights = weights or {}

    def scores(self, found: list) -> np.ndarray:
        out = np.zeros((len(found), len(KINDS)))
        for row, (_, _, named) in enumerate(found):
            for f in named:
                w = self.weights.get(f)
                if w is not None:
                    out[row] += w
        return out

    def marginals(self, n: int, found: list, scores: np.ndarray) -> np.ndarray:
        """Probability of each (segment, kind) under all segmentations of ``n`` tokens."""
        inside = scores.max(axis=1) + np.log(np.exp(scores - scores.max(axis=1, keepdims=True)).sum(axis=1))
        ending: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        starting: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for (i, j, _), s in zip(found, inside.tolist()):
            ending[j].append((i, s))
            starting[i].append((j, s))
        ahead, back = np.zeros(n + 1), np.zeros(n + 1)
        for j in range(1, n + 1):
            terms = [ahead[j - 1], *(ahead[i] + s for i, s in ending[j])]
            top = max(terms)
            ahead[j] = top + np.log(sum(np.exp(t - top) for t in terms)) if len(terms) > 1 else top
        for i in range(n - 1, -1, -1):
            terms = [back[i + 1], *(back[j] + s for j, s in starting[i])]
            top = max(terms)
            back[i] = top + np.log(sum(np.exp(t - top) for t in terms)) if len(terms) > 1 else top
        place = np.array([ahead[i] + back[j] for i, j, _ in found]) - ahead[n]
        return np.exp(np.minimum(scores + place[:, None], 0.0))

    def best(self, n: int, found: list, scores: np.ndarray) -> list[tuple[int, int]]:
        """(segment, kind) of the best segmentation."""
        kind = scores.argmax(axis=1)
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        for row, (_, j, _) in enumerate(found):
            ending[j].append(row)
        value, choice = [0.0] * (n + 1), [-1] * (n + 1)
        for j in range(1, n + 1):
            value[j] = value[j - 1]
            for row in ending[j]:
                v = value[found[row][0]] + scores[row, kind[row]]
                if v > value[j]:
                    value[j], choice[j] = v, row
        out, j = [], n
        while j > 0:
            row = choice[j]
            if row < 0:
                j -= 1
            else:
                out.append((row, int(kind[row])))
                j = found[row][0]
        return out[::-1]

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) of the best segmentation's sure segments, of all stretches."""
        out = []
        for start, end in stretches(text):
            tokens, found = segments(text, start, end)
            if not found:
                continue
            scores = self.scores(found)
            if scores.max() <= 0:
                continue
            sure = self.marginals(len(tokens), found, scores)
            out += [(KINDS[k], tokens[found[row][0]][0], tokens[found[row][1] - 1][1])
                    for row, k in self.best(len(tokens), found, scores) if sure[row, k] >= SURE]
        return out


def train(texts: list[str], passes: int = PASSES) -> SemiMarkov:
    """Likelihood training on the base spans of ``texts``, by steps of one stretch."""
    model = SemiMarkov()
    squares: dict[str, np.ndarray] = {}
    examples = []
    for text in texts:
        base = {(a, b): k for k, a, b in base_spans(text)}
        for start, end in stretches(text):
            tokens, found = segments(text, start, end)
            if found:
                target = np.zeros((len(found), len(KINDS)))
                for row, (i, j, _) in enumerate(found):
                    kind = base.get((tokens[i][0], tokens[j - 1][1]))
                    if kind:
                        target[row, KINDS.index(kind)] = 1
                examples.append((len(tokens), found, target))
    rng = np.random.default_rng(7)
    for _ in range(passes):
        for number in rng.permutation(len(examples)).tolist():
            n, found, target = examples[number]
            slope = target - model.marginals(n, found, model.scores(found))
            for row in np.flatnonzero(np.abs(slope).max(axis=1) > 1e-3).tolist():
                for f in found[row][2]:
                    if f not in model.weights:
                        model.weights[f] = np.zeros(len(KINDS))
                        squares[f] = np.full(len(KINDS), 1e-2)
                    step = slope[row] - PENALTY * model.weights[f]
                    squares[f] += step * step
                    model.weights[f] += RATE * step / np.sqrt(squares[f])
    return model


def fit(docs: DataFrame, sample: int = SAMPLE, examples: int = EXAMPLES, longest: int = LONGEST_EXAMPLE) -> SemiMarkov:
    """The model of at most ``examples`` stretches, none over ``longest`` characters, of at most
    ``sample`` documents with digits or at-signs."""
    keys = written(docs.filter(F.col("text").rlike("[0-9@]")).select("doc_id", F.xxhash64("doc_id", "text").alias("hash")),
                   "pii-keys")
    chosen = sampled(keys, F.col("hash"), sample).select(F.col("hash").alias("_hash")).distinct()
    # the parts of the sampled texts that training reads: stretches, cut out in the tasks
    parts = (docs.select("text", F.xxhash64("doc_id", "text").alias("hash"))
             .join(F.broadcast(chosen), F.col("hash") == F.col("_hash")).select("text")
             .mapInArrow(cut_out, "part string").filter(F.length("part") <= longest))
    return train(sorted(r["part"] for r in parts.orderBy(F.xxhash64("part"), "part").limit(examples).collect()))


def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts -> their stretches, with the characters at both borders."""
    for batch in slices(batches):
        parts = [t[max(0, a - 2):b + 2] for t in batch.column("text").to_pylist() if t for a, b in stretches(t)]
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.string())], names=["part"])


def all_spans(text: str, model: SemiMarkov) -> tuple[list, list]:
    """(base spans, all spans), both by kind as listed, then start."""
    base = base_spans(text)
    if not _TRIGGER.search(text):
        return base, base
    added = [s for s in model.spans(text) if all(s[2] <= a or b <= s[1] for _, a, b in base)]
    return base, sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def marked(model: SemiMarkov, keep: list[str]):
    """``mapInArrow`` function: adds base_spans and spans, as lists of kind:start:end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [all_spans(t or "", model) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep),
                 *(pa.array([[f"{k}:{a}:{b}" for k, a, b in pair[side]] for pair in found], pa.list_(pa.string()))
                   for side in (0, 1))], names=[*keep, "base_spans", "spans"])
    return run


def find_spans(docs: DataFrame, model: SemiMarkov, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with base_spans and spans (arrays of kind:start:end)."""
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([*(f"`{c}` {fields[c]}" for c in keep), "base_spans array<string>, spans array<string>"])
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(marked(model, keep), schema)


def masked(docs: DataFrame, model: SemiMarkov) -> DataFrame:
    """``docs`` with every found span replaced by its kind in angle brackets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = []
            for text in batch.column("text").to_pylist():
                if text:
                    parts, at = [], 0
                    for kind, a, b in sorted(all_spans(text, model)[1], key=lambda s: s[1:]):
                        if a >= at:
                            parts += [text[at:a], f"<{kind}>"]
                            at = b
                    text = "".join([*parts, text[at:]])
                texts.append(text)
            place = batch.schema.names.index("text")
            columns = list(batch.columns)
            columns[place] = pa.array(texts, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
    return docs.mapInArrow(run, docs.schema)


def op9(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base), base_sha256, spans, n_added of every document row."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda s: s.startswith(f"{kind}:"))).cast("long").alias(f"n_{kind}")

    return find_spans(docs, fit(docs), ["doc_id"]).select(
        "doc_id", *map(count, KINDS), F.sha2(F.array_join("base_spans", ","), 256).alias("base_sha256"),
        F.array_join("spans", ",").alias("spans"),
        (F.size("spans") - F.size("base_spans")).cast("long").alias("n_added"))
