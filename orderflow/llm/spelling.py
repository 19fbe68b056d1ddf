"""Operator 11: spelling variants, by blocked Gram matrices of letter counts.

Two words are near if one inserted, deleted or replaced letter parts them.  A replacement changes
two letter counts by one, an insertion one of them, so near words' count vectors are at most two
apart in squared distance, and their lengths equal or adjacent.  Words meet in blocks; in a block
one product of its count matrix with itself gives all squared distances, pairs at most two apart
are kept and verified letter by letter.

Blocks: the letters are dealt into ``PARTS`` parts.  A replacement touches two of them at most, an
insertion one, so near words of one length agree in all counts of two parts, and near words of
adjacent length in those of parts 0 and 1 or of parts 2 and 3.  A block holds the words of one
length that agree in two given parts (its own words) and, for those two choices, the words one
letter shorter (its guests).  A pair that shares several blocks counts in the first alone.  A block
of more than ``TILE`` words is cut into tiles; every two tiles meet in a cell of their own, so no
task holds more than about two tiles of one block and no pair is missed.

A word's form is its near word of largest count (ties: the smallest in code-point order) if that
count is at least ``RATIO`` times its own; its root is where its forms lead.  Counts grow tenfold
along the way, so it ends, and it is followed by doubling steps over written tables.

Defined cases: null and empty texts have no words; a null document id counts as an empty one in
the query's check sum; words of any length take part (long ones in blocks of their own width);
repeated rows count each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.base import written
from orderflow.llm.words import slices

#: Fewest letters and fewest occurrences of a word, and how many times commoner a form has to be.
LETTERS, OCCURRENCES, RATIO = 7, 2, 10
#: One occurrence class in so many loses a letter, in the query.
DAMAGE = 31
#: Letter classes: code points modulo this; all letters of the query have classes of their own.
CLASSES = 192
#: Letters in rough order of frequency, dealt in turn to the parts, so that each part tells words apart.
FREQUENT = "eanirtoslducmghpbvfzkwyjxq"
PARTS = 4
#: Pairs of parts that make blocks; guests enter the first two alone.
PAIRS = [(0, 1), (2, 3), (0, 2), (1, 3), (0, 3), (1, 2)]
#: Most words of a block (or tile) whose pairs one product compares.
TILE = 2048
#: Distinct words that a counting task keeps before it hands them on.
KEPT = 200_000

#: Latin-1 bytes: letters as they are, A-Z lower-cased, anything else parts words.
_LETTER = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))

_PART = np.arange(CLASSES) % PARTS
for _i, _c in enumerate(FREQUENT):
    _PART[ord(_c) % CLASSES] = _i % PARTS
_VALUES = np.random.default_rng(11).integers(1, 1 << 63, (CLASSES, 2), dtype=np.uint64)


def letter_runs(text: str | None) -> list[bytes]:
    """Maximal runs of Latin letters, A-Z lower-cased, one byte a letter."""
    return (text or "").encode("latin-1", "replace").translate(_LETTER).split()


def damaged(run: bytes, salt: int) -> bytes:
    """The run, or the run without one letter where the check sum says so."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), salt)
    if h % DAMAGE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame) -> DataFrame:
    """The query's words (word, n): damaged runs of the texts, long and frequent enough."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}
        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                salt = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
                for run, n in Counter([w for w in letter_runs(text) if len(w) >= LETTERS]).items():
                    word = damaged(run, salt)
                    if len(word) >= LETTERS:
                        total[word] = total.get(word, 0) + n
            if len(total) >= KEPT:
                yield _counted(total)
                total = {}
        yield _counted(total)

    runs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (runs.mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= OCCURRENCES))


def _counted(total: dict[bytes, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in total], pa.string()),
                                       pa.array(total.values(), pa.int64())], ["word", "n"])


def by_width(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Row numbers of words that share a power of two as width, so a long word widens few rows."""
    width = np.frexp(np.maximum(lengths, 8) - 0.5)[1]
    for w in np.unique(width):
        yield np.flatnonzero(width == w)


def code_points(words: list[str]) -> np.ndarray:
    """One row of code points a word, zeros after its end."""
    width = max(1, *map(len, words)) if words else 1
    return np.array(words, f"U{width}").view(np.uint32).reshape(len(words), width)


def letter_counts(points: np.ndarray) -> np.ndarray:
    """How often each letter class stands in each word."""
    row, column = np.nonzero(points)
    cell = row * CLASSES + points[row, column] % CLASSES
    return np.bincount(cell, minlength=len(points) * CLASSES).reshape(len(points), CLASSES)


def block_rows(words: DataFrame) -> DataFrame:
    """Each word's places: (block, pair, guest, word, n)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "word", 1 << 18):
            names, n = batch.column("word").to_pylist(), batch.column("n")
            lengths = np.array([len(w) for w in names])
            for rows in by_width(lengths):
                counts = letter_counts(code_points([names[i] for i in rows])).astype(np.uint64)
                # a number for the counts of each part; equal counts have equal numbers
                part = np.stack([counts[:, p == _PART] @ _VALUES[p == _PART, 0] for p in range(PARTS)], 1)
                size = lengths[rows].astype(np.uint64)
                for pair, (a, b) in enumerate(PAIRS):
                    for guest in (False, True) if pair < 2 else (False,):
                        key = (part[:, a] * _VALUES[pair, 1] + part[:, b] * _VALUES[pair + 50, 1]
                               + (size + np.uint64(guest)) * _VALUES[pair + 100, 1])
                        key = (key ^ (key >> np.uint64(31))) * _VALUES[0, 1]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(key.view(np.int64)), pa.array(np.full(len(rows), pair, np.int32)),
                             pa.array(np.full(len(rows), guest)), batch.column("word").take(rows), n.take(rows)],
                            ["block", "pair", "guest", "word", "n"])

    return words.select("word", "n").mapInArrow(work, "block long, pair int, guest boolean, word string, n long")


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted batches cut where a cell ends."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        if rows.num_rows:
            new = _cell_starts(rows)
            if new[-1]:
                yield rows.slice(0, new[-1])
            rest = rows.slice(new[-1])
    if rest is not None:
        yield rest


def _cell_starts(rows: pa.Table) -> np.ndarray:
    key = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in ("block", "low", "high")])
    return np.concatenate(([0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1))


def close_pairs(counts: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of one cell whose count vectors are at most two apart in squared distance.

    Cells of similar size are padded to one size and multiplied together.
    """
    kind = np.float32 if counts.sum(1).max(initial=0) < 2000 else np.float64
    used = counts[:, counts.any(0)].astype(kind)
    used = np.concatenate([used, np.zeros((1, used.shape[1]), kind)])
    norm = np.einsum("ij,ij->i", used, used)
    norm[-1] = 1e12  # the row that pads
    first, second = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    room = 1 << np.ceil(np.log2(np.maximum(sizes, 4))).astype(int)
    for width in np.unique(room):
        cells = np.flatnonzero(room == width)
        upper = np.triu(np.ones((width, width), bool), 1)
        several = max(1, (1 << 20) // (width * max(width, used.shape[1])))
        for at in range(0, len(cells), several):
            some = cells[at:at + several]
            rows = starts[some][:, None] + np.arange(width)
            rows[np.arange(width) >= sizes[some][:, None]] = len(counts)
            x, r = used[rows], norm[rows]
            apart = r[:, :, None] + r[:, None, :] - 2 * (x @ x.transpose(0, 2, 1))
            cell, i, j = np.nonzero((apart <= 2) & upper)
            first.append(rows[cell, i])
            second.append(rows[cell, j])
    return np.concatenate(first), np.concatenate(second)


def one_edit(points: np.ndarray, lengths: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether one edit parts the words of each pair of rows (lengths equal, or ``j`` one longer)."""
    a, b = points[i], points[j]
    differ = a != b
    replaced = (lengths[i] == lengths[j]) & (differ.sum(1) == 1)
    at = differ.argmax(1)
    shifted = (a[:, :-1] == b[:, 1:]) | (np.arange(a.shape[1] - 1) < at[:, None])
    return replaced | ((lengths[i] + 1 == lengths[j]) & shifted.all(1))


def _near_in_cells(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Of each word in some whole cells: how many near words these cells add, and the best of them."""
    starts = _cell_starts(rows)
    sizes = np.diff(np.append(starts, rows.num_rows))
    own = np.add.reduceat(~rows.column("guest").to_numpy(zero_copy_only=False), starts)
    live = np.repeat((sizes > 1) & (own > 0), sizes)
    cell = np.repeat(np.arange(len(sizes)), sizes)
    longest = np.maximum.reduceat(pc.utf8_length(rows.column("word")).to_numpy(), starts)
    for cells in by_width(longest):
        pick = np.flatnonzero(live & np.isin(cell, cells))
        if not len(pick):
            continue
        some = rows.take(pick)
        words = some.column("word").to_pylist()
        guest, tile, low, high, pair, n = (some.column(c).to_numpy() for c in ("guest", "tile", "low", "high", "pair", "n"))
        points = code_points(words)
        counts, lengths = letter_counts(points), (points > 0).sum(1)
        begin = np.concatenate(([0], np.flatnonzero(np.diff(cell[pick])) + 1))
        i, j = close_pairs(counts, begin, np.diff(np.append(begin, len(pick))))
        i, j = np.where(guest[j], j, i), np.where(guest[j], i, j)  # a guest, one shorter, comes first
        fits = ~guest[j] & (lengths[i] + guest[i] == lengths[j])
        fits &= (np.minimum(tile[i], tile[j]) == low[i]) & (np.maximum(tile[i], tile[j]) == high[i])
        i, j = i[fits], j[fits]
        sources, targets = [], []
        step = max(1, (1 << 22) // points.shape[1])
        for at in range(0, len(i), step):
            a, b = i[at:at + step], j[at:at + step]
            near = one_edit(points, lengths, a, b)
            a, b = a[near], b[near]
            same = np.stack([(counts[a][:, p == _PART] == counts[b][:, p == _PART]).all(1) for p in range(PARTS)], 1)
            shared = np.stack([same[:, x] & same[:, y] for x, y in PAIRS], 1)
            first = shared.argmax(1) == pair[a]
            sources += [a[first], b[first]]
            targets += [b[first], a[first]]
        if not sources or not sum(map(len, sources)):
            continue
        source, target = np.concatenate(sources), np.concatenate(targets)
        rank = np.empty(len(words), np.int64)
        rank[np.argsort(points.view(f"U{points.shape[1]}").ravel(), kind="stable")] = np.arange(len(words))
        order = np.lexsort((rank[target], -n[target], source))
        source, target = source[order], target[order]
        begin = np.concatenate(([0], np.flatnonzero(np.diff(source)) + 1))
        best = target[begin]
        word = some.column("word")
        yield pa.RecordBatch.from_arrays(
            [word.take(source[begin]).combine_chunks(), pa.array(np.diff(np.append(begin, len(source)))),
             pa.array(n[best]), word.take(best).combine_chunks()], ["word", "n_near", "form_n", "form"])


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """Of each distinct word (word, n) that has near words: n_near, and the best one as form, form_n."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_cells(batches):
            yield from _near_in_cells(rows)

    places = written(block_rows(words), "spelling-blocks")
    large = (places.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("tiles"))
             .filter("tiles > 1"))
    dealt = (places.join(large, "block", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
             .withColumn("tile", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .select("block", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"),
                     "tile", "pair", "guest", "word", "n"))
    cells = dealt.repartition("block", "low", "high").sortWithinPartitions("block", "low", "high")
    found = cells.mapInArrow(work, "word string, n_near long, form_n long, form string")
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                      F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best"))
            .select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) to (word, root): forms followed to the last, twice as far each step."""
    state = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(state.join(onward, "root", "left")
                        .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                        "spelling-roots")
        state = moved.drop("moved")
        if not moved.filter("moved").count():
            return state


def spelling_groups(words: DataFrame, ratio: int = RATIO, tile: int = TILE) -> DataFrame:
    """Distinct words (word, n) with their form, root, n_near and form_n."""
    words = written(words.select("word", "n"), "spelling-words")
    best = F.col("form_n") >= ratio * F.col("n")
    linked = written(words.join(near_words(words, tile), "word", "left")
                     .select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(best, F.col("form")).alias("form"),
                             F.when(best, F.col("form_n")).alias("form_n")), "spelling-forms")
    found = roots(linked.filter("form IS NOT NULL"))
    return (linked.join(found, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op11(docs: DataFrame) -> DataFrame:
    return spelling_groups(word_counts(docs))
