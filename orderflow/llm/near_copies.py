"""Operator 6: near-duplicate documents by ProbMinHash, banding and verification.

A document is a weighted set of shingles of ``SHINGLE`` words (its words all together if it has
fewer); a shingle weighs 1 + log of its count.  Each shingle is a Poisson process whose rate is
its weight: its arrivals fall on random registers of the signature, a register keeps the earliest
arrival's shingle, and a shingle stops as soon as its next arrival is later than every register.
Two signatures agree in a register with the probability Jaccard similarity of the documents,
which is the plain Jaccard similarity where no shingle repeats.

Equal word sequences form one class first.  Classes that share a band of registers are candidates:
in every bucket each class is verified exactly against the bucket's first and last class.  Where a
bucket still spans several components, every class outside its largest component is compared with
all the bucket's classes by signature, and pairs that may reach the threshold are verified exactly,
group by group; only links that join components leave a group.  So no pair of one bucket goes
untested, and none is listed.

Defined cases: a null or wordless text is no copy of anything; a text shorter than a shingle is a
copy of texts with the same words; texts of any length are used whole; repeated rows are copies;
an empty table gives no rows; other columns pass through where documents are returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.base import packed, shuffle_width, text_key, written
from orderflow.llm.components import components
from orderflow.llm.words import byte_texts, slices, words

SHINGLE, SIMILARITY = 5, 0.8
#: 24 bands of 6 registers: a pair at the threshold shares none with probability 0.0007, one at
#: 0.85 with 0.00001.
BANDS, ROWS = 24, 6
REGISTERS = BANDS * ROWS
#: Five standard deviations of the estimate below the threshold.
LEAST_ESTIMATE = SIMILARITY - 5 * (SIMILARITY * (1 - SIMILARITY) / REGISTERS) ** 0.5
#: Members compared against one leader, or classes of one block, in one group of rows.
GROUP = 512
#: Bytes of text sketched together.
SKETCH_BYTES = 1 << 20

_U = np.uint64
_GOLD, _M1, _M2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_BASE = 0x5851F42D4C957F2D


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> _U(30))) * _M1
    x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


def word_hashes(found: list[bytes]) -> np.ndarray:
    """64-bit hash of each word: a polynomial over its bytes, by prefix sums over all of them."""
    if not found:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(b"".join(found), np.uint8)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes)
    starts = ends - sizes
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + _U(1)) * _powers(_BASE, len(data)), out=sums[1:])
    inverse = _powers(pow(_BASE, -1, 1 << 64), len(data))
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + sizes.astype(np.uint64) * _GOLD)


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        known = np.cumprod(steps)
        if n <= 4 * SKETCH_BYTES:
            _POWERS[base] = known
    return known[:n]


def shingles(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of a document's word hashes, and their weights."""
    n = min(SHINGLE, len(hashes))
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0)
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        total = (total + hashes[k:len(hashes) - n + 1 + k]) * _M2 + _U(n)
    found, counts = np.unique(mixed(total), return_counts=True)
    return found, 1 + np.log(counts)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """ProbMinHash signatures (documents x registers) of weighted shingle sets, none empty."""
    n = len(sets)
    item = np.concatenate([s for s, _ in sets])
    rate = np.concatenate([w for _, w in sets])
    doc = np.repeat(np.arange(n), [len(s) for s, _ in sets])
    first = np.full(n * REGISTERS, np.inf)
    holder = np.zeros(n * REGISTERS, np.uint64)
    single = np.array([len(s) == 1 for s, _ in sets])
    if single.any():  # the only shingle holds every register
        holder.reshape(n, REGISTERS)[single] = np.array([s[0] for s, _ in sets if len(s) == 1])[:, None]
        first.reshape(n, REGISTERS)[single] = 0.0
    latest = first.reshape(n, REGISTERS).max(axis=1)
    time, turn = np.zeros(len(item)), 0
    alive = latest[doc] > 0
    item, rate, doc, time = item[alive], rate[alive], doc[alive], time[alive]
    while len(item):
        turn += 1
        noise = mixed(item + _U(turn * int(_GOLD) % (1 << 64)))
        uniform = ((noise >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53
        time = time - np.log(uniform) / rate
        alive = time < latest[doc]
        item, rate, doc, time, noise = item[alive], rate[alive], doc[alive], time[alive], noise[alive]
        register = doc * REGISTERS + (mixed(noise ^ _M1) % _U(REGISTERS)).astype(np.int64)
        np.minimum.at(first, register, time)
        won = first[register] == time
        holder[register[won]] = item[won]
        latest = first.reshape(n, REGISTERS).max(axis=1)
        alive = time < latest[doc]
        item, rate, doc, time = item[alive], rate[alive], doc[alive], time[alive]
    return holder.reshape(n, REGISTERS)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each signature (documents x bands)."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) * _GOLD, parts.shape[:2]).copy()
    for k in range(ROWS):
        key = mixed((key + parts[:, :, k]) * _M2 + _U(k + 1))
    return key


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The exact similarity that agreeing registers estimate."""
    both, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    p, q = a[1][ia], b[1][ib]
    only_a, only_b = a[1].sum() - p.sum(), b[1].sum() - q.sum()
    order = np.argsort(p / q)
    p, q = p[order], q[order]
    ratio = p / q
    # for x, y with a larger ratio counts p_y / p_x, the others q_y / q_x
    at = np.searchsorted(ratio, ratio, "left")
    p_after = (np.append(np.cumsum(p[::-1])[::-1], 0.0))[at] + only_a
    q_before = (np.append(0.0, np.cumsum(q)))[at] + only_b
    return float((1 / (p_after / p + q_before / q)).sum())


SKETCH = "doc_id long, text_key long, node binary, bands array<long>, signature binary"


def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text_key, text) -> SKETCH; a wordless text has no node."""
    for batch in slices(batches, size=SKETCH_BYTES):
        yield _sketch(batch, byte_texts(batch))


def _sketch(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
    found = [words(t) for t in texts]
    hashes = word_hashes([w for x in found for w in x])
    ends = np.cumsum([len(x) for x in found])
    worded = [i for i, x in enumerate(found) if x]
    bands: list = [None] * len(texts)
    packed: list = [None] * len(texts)
    nodes = [hashlib.blake2b(b" ".join(x), digest_size=16).digest() if x else None for x in found]
    if worded:
        signature = signatures([shingles(hashes[ends[i] - len(found[i]):ends[i]]) for i in worded])
        for i, keys, row in zip(worded, band_keys(signature).view(np.int64), signature.astype(np.uint16)):
            bands[i], packed[i] = keys, row.tobytes()
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("text_key"), pa.array(nodes, pa.binary()),
         pa.array(bands, pa.list_(pa.int64())), pa.array(packed, pa.binary())],
        names=["doc_id", "text_key", "node", "bands", "signature"])


def _shingled(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    return shingles(word_hashes(words(text)))


def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (leader, part), the leader's own row first -> links at the threshold or above."""
    group, head = None, None
    for batch in batches:
        leaders, parts = batch.column("leader").to_pylist(), batch.column("part").to_pylist()
        nodes, texts = batch.column("node").to_pylist(), byte_texts(batch)
        a, b = [], []
        for leader, part, node, text in zip(leaders, parts, nodes, texts):
            if group != (leader, part):
                group, head = (leader, part), None
            if node == leader:
                head = _shingled(text)
            elif head is not None and probability_jaccard(head, _shingled(text)) >= SIMILARITY:
                a.append(leader)
                b.append(node)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) among distinct ``pairs`` (leader, node), by exact similarity of ``texts`` (node, text).

    A leader with many nodes is dealt to groups of about ``GROUP``, its text going to each.
    """
    width = shuffle_width(pairs.sparkSession)
    parts = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("parts"))
    dealt = pairs.join(parts, "leader").select(
        "leader", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), "node")
    heads = parts.select("leader", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                         F.col("leader").alias("node"))
    rows = heads.union(dealt).join(texts, "node").select(
        "leader", "part", (F.col("node") != F.col("leader")).alias("member"), "node", "text")
    return (rows.repartition(width, "leader", "part").sortWithinPartitions("leader", "part", "member")
            .select("leader", "part", "node", "text").mapInArrow(compared, "a binary, b binary"))


def _agreeing(asked: np.ndarray, row: np.ndarray, band: int) -> np.ndarray:
    """Which asked signatures may reach the threshold with ``row`` and share no band before ``band``."""
    same = asked == row
    near = np.flatnonzero(same.sum(axis=1) >= LEAST_ESTIMATE * REGISTERS)
    first = same[near].reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1)
    return near[first >= band]


class _Group:
    """The rows of one (key, block, chunk): those asked for, and the components joined so far."""

    def __init__(self) -> None:
        self.asked: list[tuple] = []
        self.rows: np.ndarray | None = None
        self.parent: dict[bytes, bytes] = {}

    def root(self, component: bytes) -> bytes:
        while component in self.parent:
            component = self.parent[component]
        return component

    def partners(self, band: int, node: bytes, component: bytes, packed: bytes) -> list[tuple]:
        """The asked rows that ``node`` should be compared with."""
        if self.rows is None:
            self.rows = np.array([np.frombuffer(p, np.uint16) for _, _, p, *_ in self.asked]).reshape(-1, REGISTERS)
        found = _agreeing(self.rows, np.frombuffer(packed, np.uint16), band)
        return [self.asked[i] for i in found.tolist() if self.root(self.asked[i][1]) != self.root(component)]


CLOSE = "key long, band int, block int, chunk int, ask boolean, node binary"


def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, block, chunk), those asked for first -> the rows that have a partner to compare."""
    place, group = None, _Group()
    for batch in batches:
        out = []
        for key, band, block, chunk, ask, node, component, packed in zip(*(c.to_pylist() for c in batch.columns)):
            if place != (key, block, chunk):
                place, group, told = (key, block, chunk), _Group(), set()
            if ask:
                group.asked.append((node, component, packed))
                continue
            found = group.partners(band, node, component, packed)
            if found:
                out.append((key, band, block, chunk, False, node))
                out += [(key, band, block, chunk, True, n) for n, *_ in found if n not in told]
                told.update(n for n, *_ in found)
        columns = list(zip(*out)) or [[]] * 6
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)],
                                         names=["key", "band", "block", "chunk", "ask", "node"])


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``alike`` with their texts, sorted likewise -> verified links between components.

    A link is handed on only if it joins components that the group has not joined yet, so a group
    gives fewer links than it has rows.
    """
    place, group = None, _Group()
    for batch in batches:
        a, b = [], []
        for key, band, block, chunk, ask, node, component, packed, text in zip(
                *(c.to_pylist() for c in batch.columns[:-1]), byte_texts(batch)):
            if place != (key, block, chunk):
                place, group = (key, block, chunk), _Group()
            if ask:
                group.asked.append((node, component, packed, _shingled(text)))
                continue
            own = None
            for other, its, _, weights in group.partners(band, node, component, packed):
                if group.root(its) == group.root(component):
                    continue
                own = own or _shingled(text)
                if probability_jaccard(own, weights) >= SIMILARITY:
                    group.parent[group.root(its)] = group.root(component)
                    a.append(other)
                    b.append(node)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def open_links(members: DataFrame, links: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Verified links (a, b) between the components that still share a bucket.

    Every class outside a bucket's largest component is asked for against all the bucket's classes,
    in groups of at most about ``GROUP`` by ``GROUP``; a pair is compared in its first common bucket
    only.  First by signature, which leaves the rows that may have a link; their texts follow.
    """
    width = shuffle_width(members.sparkSession)
    found = components(links, "copy-groups")
    placed = written(members.join(found, "node", "left")
                     .withColumn("component", F.coalesce("component", F.col("node"))), "copy-members")
    sizes = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    buckets = (sizes.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("largest"),
                                        F.count(F.lit(1)).alias("components"), F.max("n").alias("most"),
                                        F.sum("n").alias("n"))
               .filter("components > 1")
               .select("key", "largest", F.ceil(F.col("n") / GROUP).cast("int").alias("blocks"),
                       F.ceil((F.col("n") - F.col("most")) / GROUP).cast("int").alias("chunks")))
    rows = placed.join(buckets, "key").join(classes.select("node", "signature"), "node")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    def one(count: str) -> Column:
        return F.pmod(F.xxhash64("node"), F.col(count)).cast("int")

    asked = (rows.filter("component != largest").withColumn("chunk", one("chunks"))
             .withColumn("block", every("blocks")).withColumn("ask", F.lit(True)))
    others = (rows.withColumn("block", one("blocks")).withColumn("chunk", every("chunks"))
              .withColumn("ask", F.lit(False)))

    def grouped(frame: DataFrame, columns: list[str]) -> DataFrame:
        return (frame.repartition(width, "key", "block", "chunk")
                .sortWithinPartitions("key", "block", "chunk", F.desc("ask")).select(columns))

    first = ["key", "band", "block", "chunk", "ask", "node"]
    close = written(grouped(asked.unionByName(others), [*first, "component", "signature"]).mapInArrow(alike, CLOSE),
                    "copy-close")
    known = placed.select("node", "component").distinct().join(classes.select("node", "signature"), "node")
    compared_rows = close.join(known, "node").join(texts, "node")
    return grouped(compared_rows, [*first, "component", "signature", "text"]).mapInArrow(joined, "a binary, b binary")


def copy_groups(docs: DataFrame) -> DataFrame:
    """Written table doc_id, text_key, rows (of both), node, component (null for a wordless text)."""
    sketch = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), "text")
                     .mapInArrow(sketched, SKETCH), "copy-sketches")
    classes = sketch.filter("node is not null").groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("home"),
        F.first("bands").alias("bands"), F.first("signature").alias("signature"))
    classes = written(classes, "copy-classes")
    exploded = classes.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = exploded.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo != hi")
    members = written(exploded.join(buckets, "key"), "copy-buckets")
    pairs = written(
        members.select("node", F.explode(F.array("lo", "hi")).alias("leader")).filter("node != leader")
        .select(F.least("node", "leader").alias("leader"), F.greatest("node", "leader").alias("node")).distinct(),
        "copy-pairs")
    wanted = (members.select("node").distinct().join(classes.select("node", "home"), "node")
              .select("node", F.col("home.doc_id").alias("_id"), F.col("home.text_key").alias("_key")))
    texts = written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), "text")
        .join(wanted.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_id"))
              & (F.col("text_key") == F.col("_key")))
        .select("node", "text").dropDuplicates(["node"]), "copy-texts")
    links = written(verified(pairs, texts), "copy-links")
    more = written(open_links(members.select("key", "band", "node"), links, classes, texts), "copy-more")
    found = components(links.union(more), "copy-components")
    rows = sketch.groupBy("doc_id", "text_key", "node").agg(F.count(F.lit(1)).alias("rows"))
    return written(rows.join(found, "node", "left")
                   .withColumn("component", F.coalesce("component", F.col("node"))), "copy-rows")


def near_copies(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, rows, component_id, kept of every distinct (doc_id, text).

    ``component_id`` is the least doc_id of the group, or the row's own without a group; the first
    text in (doc_id, text_key) order of each group is kept.
    """
    rows = copy_groups(docs)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    # written, so that the join's shuffle of a large group can be split
    heads = written(rows.filter("component is not null").groupBy("component").agg(F.min(order).alias("head"))
                    .select(F.col("component").alias("_component"), F.col("head.doc_id").alias("head_id"),
                            F.col("head.text_key").alias("head_key")), "copy-heads")
    joined = rows.join(heads, F.col("component") == F.col("_component"), "left")
    return joined.select(
        "doc_id", "text_key", "rows", F.when(F.col("component").isNull(), F.col("doc_id"))
        .otherwise(F.col("head_id")).alias("component_id"),
        (F.col("component").isNull() | (F.col("doc_id").eqNullSafe(F.col("head_id"))
                                        & (F.col("text_key") == F.col("head_key")))).alias("kept"),
        F.col("component").isNull().alias("wordless"))


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near copies, all columns kept."""
    found = written(near_copies(docs).filter("kept"), "copy-kept")
    kept = found.select("doc_id", "text_key", ((F.col("rows") > 1) & ~F.col("wordless")).alias("many"))
    rows = packed(docs).withColumn("key", text_key("row.text")).join(
        kept.hint("shuffle_hash"), F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key")))
    if found.filter("rows > 1 and not wordless").isEmpty():
        return rows.select("row.*")
    once = rows.filter("many").groupBy("doc_id", "text_key").agg(F.any_value("row").alias("row"))
    return rows.filter("not many").select("row").union(once.select("row")).select("row.*")


def op6(docs: DataFrame) -> DataFrame:
    """doc_id, component_id and kept of every document row (of a repeated row one is kept)."""
    rows = near_copies(docs).withColumn("turn", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    return rows.select("doc_id", "component_id",
                       (F.col("kept") & ((F.col("turn") == 1) | F.col("wordless"))).alias("kept"))
