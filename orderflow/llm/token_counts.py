"""Operator 4: token counts through a digest cache.

A text's count depends on its normalised content and on the tokenizer's version.  The cache is a
table (content digest, tokenizer digest, n_tokens); texts are joined to it by digest, one text of
each missing digest is encoded, the new counts are appended, and every row takes its count from
the cache.

Defined cases: a null text counts as an empty one (0 tokens); repeated rows and equal texts share
one encoding; texts that differ in white-space runs only share a digest where the tokenizer drops
white space; an empty table appends nothing.  Extra columns are kept out of the way: only doc_id
and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm.base import written
from orderflow.llm.words import slices

CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"
#: Longest text, in tokens, that is not over the limit.
LIMIT = 2048


def tokenizer_digest(path: str) -> str:
    """Version of a tokenizer: the SHA-256 of its file, as hex."""
    with open(path, "rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()


def content_digest(text: Column, drops_white_space: bool) -> Column:
    """Digest of the normalised content: runs of ASCII white space count as one blank if the
    tokenizer drops white space, else the text counts as it is; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    if drops_white_space:
        text = F.regexp_replace(text, r"[ \t\n\r\f\x0B]+", " ")
    return F.unhex(F.sha2(text, 256))


def drops_white_space(path: str) -> bool:
    """Whether the tokenizer file's split leaves white space out (probed, not assumed)."""
    from orderflow.llm.tokens import encoder
    probe = [x.tolist() for x in encoder(path).whole(["a b", " a\n\n b\t", "a \r\n b"])]
    return probe[0] == probe[1] == probe[2]


def read_cache(spark: SparkSession, cache: str) -> DataFrame:
    """The cache table; an empty one if nothing is stored there yet."""
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache)
    return spark.read.schema(CACHE_SCHEMA).parquet(cache)


def encoded_counts(path: str):
    """``mapInArrow`` function: (digest, text) -> (digest, n_tokens)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from orderflow.llm.tokens import encoder
        count = encoder(path).counts
        for batch in slices(batches):
            n = count(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(n, pa.int64())], names=["digest", "n_tokens"])
    return run


def token_counts(docs: DataFrame, path: str, cache: str) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every row of ``docs``.

    ``path``: tokenizer file; ``cache``: folder of the cache table, read first and appended to.
    Only digests and row keys are joined; each missing text crosses the network once, on a
    (digest, doc_id) key that many copies of one text do not crowd.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(path)
    digest = content_digest(F.col("text"), drops_white_space(path))
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), digest.alias("digest"))
    rows = written(keyed.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")),
                   "token-digests")
    stored = read_cache(spark, cache).filter(F.col("tokenizer") == version)
    # max over the ids: a null id stands in only where a digest has no other
    chosen = (rows.groupBy("digest").agg(F.max("doc_id").alias("_id"))
              .join(stored.select("digest"), "digest", "left_anti")
              .withColumnRenamed("digest", "_digest"))
    missing = (keyed.join(chosen.hint("shuffle_hash"),
                          (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id")))
               .select("digest", "text"))
    fresh = (missing.mapInArrow(encoded_counts(path), "digest binary, n_tokens long")
             .dropDuplicates(["digest"]))  # a row repeated under one id was encoded twice
    fresh.select("digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)
    # written, so that the join's shuffle of a digest with many rows can be split
    counts = written(spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("tokenizer") == version)
                     .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "token-found")
    return rows.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens")


def op4(docs: DataFrame, path: str, cache: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document row."""
    return token_counts(docs, path, cache).withColumn("over_limit", F.col("n_tokens") > LIMIT)
