"""Operator 7: token ids in compressed binary files, by static range asymmetric numeral coding.

Every text is encoded once, one frequency table over all ids is built, the documents are
range-sorted by doc_id, and each range is cut into blocks of whole documents that are coded
independently (``rans``).  A block carries its documents' ids and lengths, its position, decoder
checkpoints and a checksum over all of this and the frequency table, so blocks decode in parallel
and in any order, and a block that was changed in any field, or meets another table, is refused
before it is decoded.

A block that is long because of a long document is not decoded by one task: its stretches between
checkpoints are dealt to tasks, each with its share of the words, and a document's lengths and check
sums are put together from its stretches.

The files: ``<path>/blocks`` and ``<path>/table`` as Parquet.  Token positions count from the
first document in ascending doc_id order (null ids last, equal ids by text).

Defined cases: a null text is an empty one and gives the end id alone; repeated rows are kept as
often as they come; a very long text is one document in one block; an empty table gives empty
files; columns besides doc_id and text are not stored; a corrupted file raises ``ValueError``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderflow.llm import rans
from orderflow.llm.tokens import KEPT_CHUNKS
from orderflow.llm.base import shuffle_width, text_key, written
from orderflow.llm.words import slices

END_ID = 2
#: A block ends with the document that brings it to this many ids.
BLOCK_IDS = 1 << 19
IDS_SCHEMA = "doc_id long, text_key long, n_tokens long, ids binary"
BLOCK_SCHEMA = ("range int, block int, range_start long, n_tokens long, doc_ids array<long>, doc_sizes array<long>, "
                "lanes int, payload binary, states binary, mark_rows array<int>, mark_words array<long>, "
                "mark_states binary, checksum long")
DOC_SCHEMA = "doc_id long, range int, inside long, n_tokens long, ids_crc32 long"
#: Blocks with more checkpoints than this are decoded stretch by stretch, by any tasks.
LONG_MARKS = 8
PIECE_SCHEMA = "doc_id long, range int, block int, document int, stretch int, inside long, n_tokens long, ids_crc32 long"


def encoded_ids(path: str, end_id: int, kept: int = KEPT_CHUNKS):
    """``mapInArrow`` function: (doc_id, text_key, text) -> ids of each text and the end id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from orderflow.llm.tokens import encoder
        coder = encoder(path, kept)
        end = np.array([end_id], "<u4")
        for batch in slices(batches):
            ids = [np.append(x, end) for x in coder.ids(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(map(len, ids), pa.int64()),
                 pa.array([_packed(x) for x in ids], pa.binary())],
                names=["doc_id", "text_key", "n_tokens", "ids"])
    return run


def _packed(ids: np.ndarray) -> bytes:
    """Ids as 16-bit integers after a 0 byte, or as 32-bit ones after a 1 byte."""
    small = ids.max(initial=0) < 1 << 16
    return b"\0" + ids.astype("<u2").tobytes() if small else b"\1" + ids.astype("<u4").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u2" if data[0] == 0 else "<u4", offset=1).astype(np.uint32)


def counted_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each id comes in a partition: at most one row per id of the vocabulary."""
    counts = np.zeros(0, np.int64)
    for batch in batches:
        parts = [_unpacked(x) for x in batch.column("ids").to_pylist()]
        if parts:
            new = np.bincount(np.concatenate(parts))
            if len(new) > len(counts):
                counts = np.concatenate([counts, np.zeros(len(new) - len(counts), np.int64)])
            counts[:len(new)] += new
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())],
                                     names=["id", "n"])


def table_digest(freq: np.ndarray) -> int:
    used = np.flatnonzero(freq)
    return rans.checksum(used.tolist(), np.asarray(freq)[used].tolist())


def block_checksum(row: dict, table: int) -> int:
    """Over every field of a block and the digest of its table."""
    return rans.checksum(table, *[row[f.name] for f in _BLOCK if f.name != "checksum"])


def sound(row: dict, table: int) -> dict:
    """The block, or ``ValueError`` if anything in it is not as it was written."""
    if any(row[f.name] is None for f in _BLOCK) or block_checksum(row, table) != row["checksum"]:
        raise ValueError(f"block {row['block']} of range {row['range']}: its checksum does not match")
    return row


def coded_blocks(freq: np.ndarray):
    """``mapInArrow`` function: sorted documents of one range -> its blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shared, digest = rans.Table.of(freq), table_digest(freq)
        where = TaskContext.get().partitionId()
        held: list[tuple[int, np.ndarray]] = []
        size = start = number = 0

        def block() -> pa.RecordBatch:
            ids = np.concatenate([x for _, x in held])
            row = {"range": where, "block": number, "range_start": start, "n_tokens": len(ids),
                   "doc_ids": [d for d, _ in held], "doc_sizes": [len(x) for _, x in held],
                   **rans.encode(ids, shared)}
            row["checksum"] = block_checksum(row, digest)
            return pa.RecordBatch.from_pylist([row], schema=_BLOCK)

        for batch in batches:
            for doc, data in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                ids = _unpacked(data)
                held.append((doc, ids))
                size += len(ids)
                if size >= BLOCK_IDS:
                    yield block()
                    start, number, held, size = start + size, number + 1, [], 0
        if held:
            yield block()
    return run


_BLOCK = pa.schema([("range", pa.int32()), ("block", pa.int32()), ("range_start", pa.int64()),
                    ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                    ("doc_sizes", pa.list_(pa.int64())), ("lanes", pa.int32()), ("payload", pa.binary()),
                    ("states", pa.binary()), ("mark_rows", pa.list_(pa.int32())),
                    ("mark_words", pa.list_(pa.int64())), ("mark_states", pa.binary()),
                    ("checksum", pa.int64())])


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, kept: int = KEPT_CHUNKS) -> None:
    """Encode every text of ``docs`` and write the files to ``path``.

    A worker remembers the ids of ``kept`` chunks (about 300 bytes each), which changes its memory and
    time alone.
    """
    spark = docs.sparkSession
    ids = written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"),
                    F.coalesce("text", F.lit("")).alias("text"))
        .mapInArrow(encoded_ids(tokenizer, end_id, kept), IDS_SCHEMA), "token-ids", compression="zstd")
    # one row per id of the vocabulary: bounded by the tokenizer, whatever the corpus
    found = (ids.select("ids").mapInArrow(counted_ids, "id long, n long")
             .groupBy("id").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros(int(found["id"].max()) + 1 if len(found) else 1, np.int64)
    counts[found["id"].to_numpy(int)] = found["n"].to_numpy(int)
    freq = rans.quantised(counts)
    used = np.flatnonzero(freq).tolist()
    spark.createDataFrame([(i, int(freq[i])) for i in used], "id long, freq long").coalesce(1).write.parquet(
        f"{path}/table")
    order = [F.col("doc_id").asc_nulls_last(), F.col("text_key")]
    (ids.repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order)
     .select("doc_id", "ids").mapInArrow(coded_blocks(freq), BLOCK_SCHEMA)
     .write.parquet(f"{path}/blocks"))


def shared_table(spark: SparkSession, path: str) -> np.ndarray:
    """The files' frequency table (bounded by the vocabulary)."""
    rows = spark.read.parquet(f"{path}/table").toPandas()
    freq = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 1, np.int64)
    freq[rows["id"].to_numpy(int)] = rows["freq"].to_numpy(int)
    return freq


def _documents(ids: np.ndarray, sizes: np.ndarray) -> list[int]:
    """Check sums of consecutive documents of these sizes."""
    raw, ends = memoryview(ids.astype("<u4").tobytes()), 4 * np.cumsum(sizes)
    return [zlib.crc32(raw[a:b]) for a, b in zip((ends - 4 * sizes).tolist(), ends.tolist(), strict=True)]


def decoded_documents(freq: np.ndarray, with_ids: bool):
    """``mapInArrow`` function: blocks -> their documents, each block on its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, digest = rans.Table.of(freq), table_digest(freq)
        for batch in batches:
            for i in range(batch.num_rows):
                block = sound(batch.slice(i, 1).to_pylist()[0], digest)
                ids = rans.decode(block, block["n_tokens"], shared)
                sizes = np.array(block["doc_sizes"], np.int64)
                ends = np.cumsum(sizes)
                columns = [pa.array(block["doc_ids"], pa.int64()),
                           pa.array([block["range"]] * len(sizes), pa.int32()),
                           pa.array(block["range_start"] + ends - sizes, pa.int64()), pa.array(sizes, pa.int64()),
                           pa.array(_documents(ids, sizes), pa.int64())]
                if with_ids:
                    cuts = zip((ends - sizes).tolist(), ends.tolist(), strict=True)
                    columns.append(pa.array([ids[a:b].tolist() for a, b in cuts], pa.list_(pa.int64())))
                names = ["doc_id", "range", "inside", "n_tokens", "ids_crc32", "ids"][:len(columns)]
                yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


def stretches(freq: np.ndarray):
    """``mapInArrow`` function: long blocks -> what lies between their checkpoints, with the documents there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = table_digest(freq)
        for batch in batches:
            for i in range(batch.num_rows):
                block = sound(batch.slice(i, 1).to_pylist()[0], digest)
                lanes, rows = block["lanes"], -(-block["n_tokens"] // block["lanes"])
                starts = [0, *block["mark_rows"]]
                words = [0, *block["mark_words"], len(block["payload"]) // 4]
                states = [block["states"], *(block["mark_states"][8 * lanes * k:8 * lanes * (k + 1)]
                                             for k in range(len(block["mark_rows"])))]
                ends = np.cumsum(block["doc_sizes"])
                for k, (first, last) in enumerate(zip(starts, [*starts[1:], rows], strict=True)):
                    begin, end = first * lanes, min(last * lanes, block["n_tokens"])
                    a, b = np.searchsorted(ends, begin, "right"), np.searchsorted(ends, end, "left") + 1
                    # sizes as they are cut here: the first and last document may go on outside
                    inside = np.minimum(ends[a:b], end) - np.maximum(ends[a:b] - block["doc_sizes"][a:b], begin)
                    row = {f: block[f] for f in ("range", "block", "lanes")} | {
                        "stretch": k, "rows": last - first, "n_tokens": end - begin,
                        "range_start": block["range_start"] + begin, "first_document": int(a),
                        "doc_ids": block["doc_ids"][a:b], "doc_sizes": inside.tolist(), "states": states[k],
                        "payload": block["payload"][4 * words[k]:4 * words[k + 1]]}
                    yield pa.RecordBatch.from_pylist([row], schema=_STRETCH)
    return run


_STRETCH = pa.schema([("range", pa.int32()), ("block", pa.int32()), ("stretch", pa.int32()), ("first_document", pa.int32()),
                      ("rows", pa.int32()), ("lanes", pa.int32()), ("n_tokens", pa.int64()), ("range_start", pa.int64()),
                      ("doc_ids", pa.list_(pa.int64())), ("doc_sizes", pa.list_(pa.int64())), ("states", pa.binary()),
                      ("payload", pa.binary())])
STRETCH_SCHEMA = ("range int, block int, stretch int, first_document int, rows int, lanes int, n_tokens long, "
                  "range_start long, doc_ids array<long>, doc_sizes array<long>, states binary, payload binary")


def decoded_pieces(freq: np.ndarray):
    """``mapInArrow`` function: stretches -> the pieces of documents in them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = rans.Table.of(freq)
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.slice(i, 1).to_pylist()[0]
                ids = rans.decode(part, part["n_tokens"], shared, last=False)
                sizes = np.array(part["doc_sizes"], np.int64)
                n = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part["doc_ids"], pa.int64()), pa.array([part["range"]] * n, pa.int32()),
                     pa.array([part["block"]] * n, pa.int32()), pa.array(range(part["first_document"], part["first_document"] + n), pa.int32()),
                     pa.array([part["stretch"]] * n, pa.int32()), pa.array(part["range_start"] + np.cumsum(sizes) - sizes, pa.int64()),
                     pa.array(sizes, pa.int64()), pa.array(_documents(ids, sizes), pa.int64())],
                    names=[f.split()[0] for f in PIECE_SCHEMA.split(", ")])
    return run


def joined_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents' pieces (in order, as lists) -> their lengths and check sums."""
    for batch in batches:
        sizes, sums = batch.column("sizes").to_pylist(), batch.column("sums").to_pylist()
        whole = []
        for lengths, crcs in zip(sizes, sums, strict=True):
            crc = 0
            for length, part in zip(lengths, crcs, strict=True):
                crc = rans.crc_of_both(crc, part, 4 * length)
            whole.append(crc)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("range"), batch.column("inside"), pa.array(map(sum, sizes), pa.int64()),
             pa.array(whole, pa.int64())], names=["doc_id", "range", "inside", "n_tokens", "ids_crc32"])


def long_documents(blocks: DataFrame, freq: np.ndarray) -> DataFrame:
    """The documents of long blocks, decoded from their checkpoints by any tasks."""
    dealt = blocks.mapInArrow(stretches(freq), STRETCH_SCHEMA).repartition("range", "block", "stretch")
    pieces = dealt.mapInArrow(decoded_pieces(freq), PIECE_SCHEMA)
    # a document has a piece for each stretch that it lies in: as many as checkpoints of its block
    ordered = (pieces.groupBy("range", "block", "document")
               .agg(F.any_value("doc_id").alias("doc_id"), F.min("inside").alias("inside"),
                    F.sort_array(F.collect_list(F.struct("stretch", "n_tokens", "ids_crc32"))).alias("parts")))
    return ordered.select("doc_id", "range", "inside", F.col("parts.n_tokens").alias("sizes"),
                          F.col("parts.ids_crc32").alias("sums")).mapInArrow(joined_pieces, DOC_SCHEMA)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False, long_marks: int = LONG_MARKS) -> DataFrame:
    """The documents of the files: doc_id, start, n_tokens, ids_crc32 (and ids, block by block)."""
    blocks, freq = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks"), shared_table(spark, path)
    sums = blocks.groupBy("range").agg(F.sum("n_tokens").alias("_n"))
    # one row per range: bounded by the shuffle width
    before = sums.select("range", F.coalesce(F.sum("_n").over(
        Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    if with_ids:
        docs = blocks.mapInArrow(decoded_documents(freq, True), DOC_SCHEMA + ", ids array<long>")
    else:
        long = F.coalesce(F.size("mark_rows"), F.lit(0)) > long_marks
        docs = (blocks.filter(~long).mapInArrow(decoded_documents(freq, False), DOC_SCHEMA)
                .unionByName(long_documents(blocks.filter(long), freq)))
    return (docs.join(F.broadcast(before), "range")
            .select("doc_id", (F.col("_before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32",
                    *(["ids"] if with_ids else [])))


def op7(docs: DataFrame, tokenizer: str, path: str, kept: int = KEPT_CHUNKS) -> DataFrame:
    """Write the files of ``docs``, read them back: doc_id, start, n_tokens, ids_crc32."""
    write_token_files(docs, tokenizer, path, kept=kept)
    return read_token_files(docs.sparkSession, path)
