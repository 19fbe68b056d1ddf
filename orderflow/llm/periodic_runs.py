"""Operator 13: stretches of periodically repeating words, by recursive frequency splitting.

A run is a stretch of words with smallest period q (words q apart are identical), at least
``max(shortest, 2 q)`` words long, that no neighbouring word extends.  Every word of a run stands in
it twice or more.  So a word seen once in a segment is in none of its runs: such words split the
segment, the parts are counted anew and split again until nothing changes, and parts shorter than
the shortest run go.  All segments of a text are split together, a level of recursion at a time.

What survives is scanned lag by lag.  A run of period q agrees with itself q words on in a stretch
of ``max(shortest - q, q)`` places or more, so among every ``q - g + 1`` places there is one whose g
words and those q on are the same.  With g about a quarter to half of q these places alone are
looked at, by the numbers of their grams: about L log L of them for all lags of a segment of L
words.  Where one agrees the lag is scanned in full, so results don't rest on the grams.  Lags go
up, so a stretch whose smallest period divides the lag has been found before; places inside such a
run are passed over.

A text is worked on whole inside one task, rows are cut into batches by bytes of text; nothing is
shuffled.  Defined cases: null, empty and wordless texts have no words and no runs; repeated rows
each have their own; an empty table gives no rows; other columns pass through ``collapsed`` under
any names; a null id counts as an empty one in the query's check sum.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.base import packed
from orderflow.llm.words import byte_texts, slices

#: Fewest words of a run, and its least number of periods.
SHORTEST, TIMES = 12, 2
#: Words of a gram; a qualifying run agrees with itself in at least this many places in a row.
GRAM = SHORTEST // TIMES


def numbered(words: list[bytes]) -> np.ndarray:
    """Words as numbers, equal for equal words."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def segments(ids: np.ndarray) -> list[tuple[int, int]]:
    """Parts [start, end) of ``ids`` in which every word occurs twice or more, and that can hold a run."""
    at = np.arange(len(ids))
    part = np.zeros(len(ids), np.int64)
    while len(at) >= SHORTEST:
        width = int(ids.max()) + 1
        _, where, times = np.unique(part * width + ids[at], return_inverse=True, return_counts=True)
        stay = times[where] >= TIMES
        # words next to each other stay in one segment unless a rare word, or an earlier cut, is between
        at, part = at[stay], part[stay]
        cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(part) != 0)) + 1
        starts = np.concatenate(([0], cut)) if len(at) else cut
        sizes = np.diff(np.append(starts, len(at)))
        long = sizes >= SHORTEST
        kept = np.repeat(long, sizes)
        part = np.repeat(np.arange(len(sizes)), sizes)[kept]
        at = at[kept]
        if stay.all() and long.all():
            return list(zip(at[starts].tolist(), (at[starts] + sizes).tolist(), strict=True))
    return []


def grams(ids: np.ndarray) -> list[np.ndarray]:
    """Numbers of all stretches of ``GRAM``, 2 ``GRAM``, 4 ``GRAM`` ... words, up to a quarter of ``ids``.

    Equal stretches have equal numbers (others may share one).
    """
    times = np.uint64(0x9E3779B97F4A7C15)
    first = np.zeros(len(ids) - GRAM + 1, np.uint64)
    for k in range(GRAM):
        first = first * times + ids[k:k + len(first)].astype(np.uint64) + np.uint64(1)
    levels, size = [first], GRAM
    while 8 * size <= len(ids):
        last = levels[-1]
        levels.append((last[:-size] ^ (last[:-size] >> np.uint64(29))) * times + last[size:])
        size *= 2
    return levels


def scan(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs (start, end, period) of one segment by a scan of its lags."""
    n, levels = len(ids), grams(ids)
    found: list[tuple[int, int, int]] = []
    known = np.empty((0, 3), np.int64)
    for q in range(1, n // TIMES + 1):
        level = max(0, (q // (2 * GRAM)).bit_length() - 1)
        size, gram = GRAM << level, levels[level]
        step = max(1, q - size + 1)
        same = gram[:-q:step] == gram[q::step]
        if not same.any():
            continue
        places = np.flatnonzero(same) * step
        for s, e, _ in known[q % known[:, 2] == 0]:
            places = places[(places < s) | (places + q + size > e)]
        if not len(places):
            continue
        same = np.concatenate(([False], ids[:-q] == ids[q:], [False]))
        edges = np.flatnonzero(same[1:] != same[:-1])
        starts, ends = edges[::2], edges[1::2] + q
        fits = ends - starts >= max(SHORTEST, TIMES * q)
        old = {(s, e) for s, e, _ in found}
        new = [(s, e, q) for s, e in zip(starts[fits].tolist(), ends[fits].tolist(), strict=True) if (s, e) not in old]
        if new:
            found += new
            known = np.array(found, np.int64)
    return found


def runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a text's words, by start, then period."""
    if len(words) < SHORTEST:
        return []
    ids = numbered(words)
    return sorted((a + s, e - s, q) for a, b in segments(ids) for s, e, q in scan(ids[a:b]))


def collapse(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run has after its first period."""
    keep = np.ones(len(words), bool)
    for start, length, q in found:
        keep[start + q:start + length] = False
    return [words[i] for i in np.flatnonzero(keep)] if found else words


def collapsed(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each text that has runs collapsed to one period of each; others as they are."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            old, new = batch.column("text").to_pylist(), []
            for value, data in zip(old, byte_texts(batch), strict=True):
                words = data.split()
                found = runs(words)
                new.append(b" ".join(collapse(words, found)).decode() if found else value)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(new, pa.string())], ["row", "text"])

    named = packed(docs).select("row", F.col(f"row.`{text}`").alias("text"))
    done = named.mapInArrow(work, named.schema)
    return done.select(F.col("row").withField(f"`{text}`", F.col("text")).alias("row")).select("row.*")


def dealt_words(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's words: in a tenth of the documents, by check sum of the id, the end is made periodic."""
    g, rest = divmod(zlib.crc32(b"" if doc_id is None else b"%d" % doc_id), 10)
    if rest or not words:
        return words
    n = len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op13(docs: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), byte_texts(batch), strict=True):
                words = dealt_words(doc_id, data.split())
                found = runs(words)
                start, length, q = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
                listed = "".join(f"{s},{k},{p}\n" for s, k, p in found).encode()
                out.append((doc_id, len(found), start, length, q, 1000 * length // q if found else None,
                            hashlib.sha256(listed).hexdigest(),
                            hashlib.sha256(b" ".join(collapse(words, found))).hexdigest()))
            columns = list(zip(*out, strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64() if k < 6 else pa.string()) for k, c in enumerate(columns)], names)

    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        work, ", ".join(f"{n} {'long' if k < 6 else 'string'}" for k, n in enumerate(names)))
