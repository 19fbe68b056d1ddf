"""Token counts and token files against the tokenizers library and exact round trips."""

import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from pyspark.sql import functions as F  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from orderflow.llm import rans, token_counts, token_files  # noqa: E402
from orderflow.llm.tokens import ChunkEncoder  # noqa: E402

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
TEXTS = ["", " ", "a", " a", "a ", "a  b", "a\n\nb", "\n", "a\n", "\na", "a\tb", "x<|endoftext|>y", "<|startoftext|>",
         "é b", "it's I'll", "é ́", "a\x1cb", "\x00 a", "日本 語　x", "1234 5", "a \n b", "a\r\nb",
         "the the, The.\nthe the", "word " * 5000, "x" * 20_000]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_chunks_give_the_library_s_ids(path):
    coder, library = ChunkEncoder(path), Tokenizer.from_file(path)
    want = [library.encode(t, add_special_tokens=False).ids for t in TEXTS]
    assert [x.tolist() for x in coder.ids(TEXTS)] == want
    assert coder.counts(TEXTS).tolist() == [len(x) for x in want]
    coder.forget()
    assert [x.tolist() for x in coder.ids(TEXTS[::-1])] == want[::-1]


def frame(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a b"), (3, None), (3, None), (7, "again"), (7, "again")]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"digest": F.lit("x"), "n_tokens": F.lit(-1), "_id": F.lit(0), "ids": F.lit("y"), "range": F.lit(1)})


def test_counts_come_through_the_cache_and_are_kept(spark, tmp_root):
    docs, library = frame(spark, TEXTS), Tokenizer.from_file(WORDS)
    got = token_counts.op4(docs, WORDS, f"{tmp_root}/cache").collect()
    want = sorted((r.doc_id if r.doc_id is not None else -1, len((r.text or "").encode()),
                   len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got) and any(r.over_limit for r in got)
    stored = spark.read.parquet(f"{tmp_root}/cache").count()
    more = docs.union(docs.limit(1).withColumn("text", F.lit("a text that is new")))
    token_counts.op4(more, WORDS, f"{tmp_root}/cache").collect()
    assert spark.read.parquet(f"{tmp_root}/cache").count() == stored + 1  # only the miss was encoded
    assert token_counts.op4(docs.limit(0), WORDS, f"{tmp_root}/none").collect() == []


def test_token_files_round_trip(spark, tmp_root):
    docs, library = frame(spark, TEXTS), Tokenizer.from_file(BYTES)
    token_files.write_token_files(docs, BYTES, f"{tmp_root}/files")
    got = token_files.read_token_files(spark, f"{tmp_root}/files", with_ids=True).orderBy("start").collect()
    want = {}
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [2]
        want.setdefault(r.doc_id, []).append(ids)
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in docs.collect()), key=lambda d: (d is None, d))
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids in want[r.doc_id]
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    assert token_files.op7(docs.limit(0), BYTES, f"{tmp_root}/empty").collect() == []


@pytest.mark.parametrize("n", [0, 1, 5, 1024, 70_001])
def test_rans_blocks_and_checkpoints(n):
    rng = np.random.default_rng(n)
    ids = (rng.pareto(0.5, n) % 50_000).astype(np.uint32)
    counts = np.bincount(ids, minlength=50_257)
    freq = rans.quantised(counts)
    assert ((freq > 0) == (counts > 0)).all() and (not n or freq.sum() == 1 << rans.BITS)
    shared = rans.Table.of(freq)
    block = rans.encode(ids, shared)
    assert np.array_equal(rans.decode(block, n, shared), ids)
    for mark, row in enumerate(block["mark_rows"]):
        assert np.array_equal(rans.decode(block, n, shared, mark, rows=3),
                              ids[row * block["lanes"]:][:3 * block["lanes"]])


def test_a_stretch_s_check_sums_join():
    data = bytes(range(256)) * 9
    for cut in (0, 1, 7, 1000, len(data)):
        assert rans.crc_of_both(zlib.crc32(data[:cut]), zlib.crc32(data[cut:]), len(data) - cut) == zlib.crc32(data)


def test_any_changed_bit_of_a_block_or_its_table_is_refused():
    rng = np.random.default_rng(3)
    ids = (rng.pareto(0.6, 60_000) % 900).astype(np.uint32)
    freq = rans.quantised(np.bincount(ids, minlength=900))
    row = {"range": 3, "block": 1, "range_start": 77, "n_tokens": len(ids), "doc_ids": [5, None, 0, 9],
           "doc_sizes": [20_000, 1, 29_999, 10_000], **rans.encode(ids, rans.Table.of(freq))}
    digest = token_files.table_digest(freq)
    row["checksum"] = token_files.block_checksum(row, digest)
    assert row["mark_rows"] and token_files.sound(row, digest) is row

    def refused(name, value, table=digest):
        with pytest.raises(ValueError, match="checksum"):
            token_files.sound({**row, name: value}, table)

    for name, value in row.items():
        if isinstance(value, bytes):
            for at in rng.integers(0, 8 * len(value), 150).tolist():
                flipped = bytearray(value)
                flipped[at // 8] ^= 1 << at % 8
                refused(name, bytes(flipped))
            refused(name, value[:-4])
        elif isinstance(value, list):
            for k, item in enumerate(value):
                for bit in range(0, 40, 3):
                    refused(name, [*value[:k], (item or 0) ^ 1 << bit, *value[k + 1:]])
            refused(name, value[1:])
            refused(name, [None if v == 0 else 0 if v is None else v for v in value] if name == "doc_ids" else value[::-1] + [0])
        else:
            for bit in range(31):
                refused(name, value ^ 1 << bit)
        refused(name, None)
    for k in rng.integers(0, 900, 100).tolist():
        other = freq.copy()
        other[k] ^= 1
        refused("block", 1, token_files.table_digest(other))


def test_long_blocks_are_read_from_their_checkpoints(spark, tmp_root):
    rng = np.random.default_rng(4)
    words = ["".join(map(chr, rng.integers(97, 123, 5))) for _ in range(400)]
    texts = [" ".join(rng.choice(words, n)) for n in (3, 50, 400_000, 0, 20, 900_000, 7)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    token_files.write_token_files(docs, BYTES, f"{tmp_root}/files")
    blocks = spark.read.parquet(f"{tmp_root}/files/blocks")
    assert max(len(r.mark_rows) for r in blocks.select("mark_rows").collect()) >= 3
    whole = token_files.read_token_files(spark, f"{tmp_root}/files", long_marks=10 ** 9)
    parts = token_files.read_token_files(spark, f"{tmp_root}/files", long_marks=0)
    assert sorted(parts.collect()) == sorted(whole.collect()) and parts.count() == len(texts)


def test_a_changed_file_raises(spark, tmp_root):
    docs = frame(spark, TEXTS)
    token_files.write_token_files(docs, BYTES, f"{tmp_root}/files")
    blocks = spark.read.parquet(f"{tmp_root}/files/blocks")
    blocks.withColumn("doc_sizes", F.reverse("doc_sizes")).write.parquet(f"{tmp_root}/changed/blocks")
    spark.read.parquet(f"{tmp_root}/files/table").write.parquet(f"{tmp_root}/changed/table")
    for marks in (0, 8):
        with pytest.raises(Exception, match="checksum does not match"):
            token_files.read_token_files(spark, f"{tmp_root}/changed", long_marks=marks).collect()
    spark.read.parquet(f"{tmp_root}/files/table").withColumn("freq", F.col("freq") + F.when(F.col("id") == 2, 1).otherwise(0)) \
        .write.parquet(f"{tmp_root}/other/table")
    blocks.write.parquet(f"{tmp_root}/other/blocks")
    with pytest.raises(Exception, match="checksum does not match"):
        token_files.read_token_files(spark, f"{tmp_root}/other").collect()


def asked(coder, monkeypatch):
    """The chunks that the library is asked for from now on."""
    seen, real = [], coder._learn
    monkeypatch.setattr(coder, "_learn", lambda chunks: (seen.extend(chunks), real(chunks))[1])
    return seen


@pytest.mark.parametrize("path", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_a_full_memory_keeps_the_chunks_that_came_again(path, monkeypatch):
    path = public_tokenizers.path(path)
    coder, library = ChunkEncoder(path, 200), Tokenizer.from_file(path)
    monkeypatch.setattr("orderflow.llm.tokens.BATCH_CHARS", 400)  # a group a text
    seen = asked(coder, monkeypatch)
    often = [f"word{i}x" for i in range(40)]
    texts = [" ".join(often + [f"once{k}n{i}" for i in range(60)] + ["a\nb", "", "  c"][k % 3:][:1]) for k in range(12)]
    got = [x.tolist() for x in coder.ids(texts)]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert coder.counts(texts).tolist() == [len(x) for x in got]
    assert coder.kept <= 200 + 110  # the group that fills it
    # the first chunk of a byte-level text begins with a line feed
    assert all(seen.count(c) == 1 for c in often[1:]) and len(seen) > 12 * 60


def test_chunks_of_a_group_are_looked_up_once(monkeypatch):
    coder = ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    looked = []

    class Known(dict):
        def get(self, chunk, default=None):
            looked.append(chunk)
            return super().get(chunk, default)

    coder.known = Known(coder.known)
    texts = ["a b a b a é \U0001f600 a b " * 50, "", "b a  a\n\nb"]
    got = [x.tolist() for x in coder.ids(texts)]
    assert got == [e.ids for e in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert len(looked) == len(set(looked)) < 20
