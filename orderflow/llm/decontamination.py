"""Operator 8: benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of the benchmark items: ``WINDOW`` consecutive words, or all words of a
shorter item.  For each pattern length a table maps a block of two words to how far the search
may move on; a block that ends a pattern has shift 0 and a bucket of the patterns with that
suffix, which are compared word by word.

Patterns go to the tasks in blocks of at most ``BLOCK_BYTES`` (measured by a count first); every
block is searched against all documents, in a pass of its own, so any number of items works.

Defined cases: a null or wordless text has no words and no hits; items without words or without
an id are left out; rows of one item_id are one item; repeated documents are marked alike; an
empty benchmark marks nothing.  Extra columns of the documents pass through.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.base import written
from orderflow.llm.words import byte_texts, slices, words

WINDOW = 10
BLOCK_BYTES = 16 << 20


def item_windows(size: int):
    """``mapInArrow`` function: items -> their distinct windows (words joined by blanks)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), byte_texts(batch)):
                found = words(text)
                if found:
                    last = max(1, len(found) - size + 1)
                    windows = list({b" ".join(found[i:i + size]): None for i in range(last)})
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(windows, pa.binary()), pa.array([item] * len(windows))],
                        names=["window", "item"])
    return run


class Searcher:
    """Wu-Manber tables of one block of (window, items)."""

    def __init__(self, rows: list[tuple[bytes, list[str]]]):
        self.items = [items for _, items in rows]
        lengths: dict[int, list[tuple[tuple[bytes, ...], int]]] = {}
        for number, (window, _) in enumerate(rows):
            pattern = tuple(window.split(b" "))
            lengths.setdefault(len(pattern), []).append((pattern, number))
        self.single = {p[0]: n for p, n in lengths.pop(1, [])}
        self.tables = [(m, *self._tables(m, patterns)) for m, patterns in sorted(lengths.items())]

    @staticmethod
    def _tables(m: int, patterns: list) -> tuple[dict, dict]:
        shift: dict[tuple[bytes, bytes], int] = {}
        bucket: dict[tuple[bytes, bytes], list] = {}
        for pattern, number in patterns:
            for end in range(1, m):
                block = pattern[end - 1:end + 1]
                distance = m - 1 - end
                if shift.get(block, m) > distance:
                    shift[block] = distance
            bucket.setdefault(pattern[-2:], []).append((list(pattern), number))
        return shift, bucket

    def search(self, text: list[bytes]) -> list[tuple[int, int, int]]:
        """(start, end, pattern) of every occurrence in the words of one text."""
        found = []
        if self.single:
            found += [(i, i + 1, self.single[w]) for i, w in enumerate(text) if w in self.single]
        n = len(text)
        for m, shift, bucket in self.tables:
            move, get, at = m - 1, shift.get, m - 1
            while at < n:
                step = get((text[at - 1], text[at]), move)
                if step:
                    at += step
                    continue
                start = at - m + 1
                for pattern, number in bucket[text[at - 1], text[at]]:
                    if text[start:at + 1] == pattern:
                        found.append((start, at + 1, number))
                        break  # patterns of one length are distinct
                at += 1
        return found


#: A block of patterns as the tasks get it: its own name and the broadcast rows.
Block = tuple[str, Broadcast]
_SEARCHERS: dict[str, Searcher] = {}


def searcher(block: Block) -> Searcher:
    """The worker's tables of a block; only the latest is kept."""
    name, rows = block
    if name not in _SEARCHERS:
        _SEARCHERS.clear()
        _SEARCHERS[name] = Searcher(rows.value)
    return _SEARCHERS[name]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def window_blocks(items: DataFrame, size: int) -> list[Block]:
    """The items' windows as broadcasts of bounded size."""
    spark = items.sparkSession
    rows = written(
        items.select(F.col("item_id").cast("string").alias("item"), "text").filter("item is not null")
        .mapInArrow(item_windows(size), "window binary, item string").distinct(), "leak-windows")
    # a row costs its words and ids, and about 300 bytes of tables for each of its words
    cost = F.octet_length("window") + F.octet_length("item") + 300 * size
    total = rows.agg(F.sum(cost)).first()[0] or 0
    n = max(1, -(-total // (BLOCK_BYTES * 8)))
    blocks = []
    for k in range(n if total else 0):
        part = rows.filter(F.pmod(F.xxhash64("window"), F.lit(n)) == k)
        windows: dict[bytes, list[str]] = {}
        for row in part.toLocalIterator():
            windows.setdefault(bytes(row["window"]), []).append(row["item"])
        blocks.append((uuid.uuid4().hex, spark.sparkContext.broadcast(list(windows.items()))))
    return blocks


HITS = "hit_spans array<bigint>, item_ids array<string>"


def marked_batches(block: Block | None, keep: list[str], carry_text: bool):
    """``mapInArrow`` function: adds n_words, hit_spans and item_ids, or extends them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = searcher(block) if block is not None else None
        for batch in slices(batches):
            old = "hit_spans" in batch.schema.names
            spans = [list(zip(x[::2], x[1::2])) for x in batch.column("hit_spans").to_pylist()] if old else None
            ids = batch.column("item_ids").to_pylist() if old else None
            sizes, all_spans, all_ids = [], [], []
            for i, data in enumerate(byte_texts(batch)):
                text = words(data)
                found = find.search(text) if find else []
                sizes.append(len(text))
                cover = merged([(a, b) for a, b, _ in found] + (spans[i] if old else []))
                all_spans.append([x for span in cover for x in span])
                all_ids.append(sorted({x for n in {n for _, _, n in found} for x in find.items[n]}
                                      | set(ids[i] if old else [])) if found or old else [])
            names = [*keep, *(["text"] if carry_text and "text" not in keep else [])]
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sizes, pa.int64()), pa.array(all_spans, pa.list_(pa.int64())),
                 pa.array(all_ids, pa.list_(pa.string()))], names=[*names, "n_words", "hit_spans", "item_ids"])
    return run


def find_items(docs: DataFrame, items: DataFrame, keep: list[str], size: int = WINDOW) -> DataFrame:
    """The columns ``keep`` of ``docs`` with n_words, hit_spans (word positions start, end, ... of
    the merged occurrences) and item_ids (sorted, as strings)."""
    blocks = window_blocks(items, size) or [None]
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    frame = docs.select(*dict.fromkeys([*keep, "text"]))
    for number, block in enumerate(blocks):
        last = number == len(blocks) - 1
        names = list(dict.fromkeys([*keep, *([] if last else ["text"])]))
        schema = ", ".join([*(f"`{c}` {fields[c]}" for c in names), "n_words bigint", HITS])
        frame = frame.mapInArrow(marked_batches(block, keep, not last), schema)
        if not last:
            frame = written(frame, "leak-pass")
    return frame


def decontaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs, with all their columns."""
    for block in window_blocks(items, size):
        docs = docs.mapInArrow(clean_batches(block), docs.schema)
    return docs


def clean_batches(block: Block):
    """``mapInArrow`` function: the rows without an occurrence."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = searcher(block)
        for batch in slices(batches):
            yield batch.filter(pa.array([not find.search(words(x)) for x in byte_texts(batch)], pa.bool_()))
    return run


def op8(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document row."""
    spans = F.col("hit_spans")
    covered = F.aggregate(F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)),
                          F.lit(0).cast("long"), lambda a, x: a + x)
    return find_items(docs, items, ["doc_id"]).select(
        "doc_id", "n_words", covered.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"))
