"""Operator 12: exact duplicates by a tree-merge of sorted digest runs, in DataFrame functions alone.

Texts are equal when they agree after every white-space character is deleted.  Each partition of
the table is a leaf holding a run: its distinct digests in order, each with its count and its best
row so far (most code points, then smallest identifier).  Leaves are numbered 0 to 2^k - 1.  A
round of the binomial tree exchanges runs among the 2^``STEP`` nodes whose numbers differ in
``STEP`` given bits only: each keeps the part of the digests that belongs to its own bits and
hands the rest over, so after k bits a node holds every run row of its share of the digest space.
At every level a node merges the sorted runs it received and keeps one row for each digest.  Rows
merge only if they are verified: beside the 64-bit digest, which orders the runs, SHA-256 and byte
length must agree, so a collision of digests stays two rows.

No node ever holds the table: after the leaves a digest has one row a node, however many copies it
has, and the answers go back by (leaf, digest), so a group with a third of all rows stays dealt
over all leaves.  The number of leaves follows ``spark.sql.shuffle.partitions``.

Defined cases: null counts as an empty text, and texts of white space alone equal it; a null
identifier is larger than any other; of rows equal in length and identifier one (the first of its
leaf) stays; texts of any length are hashed whole; an empty table gives no rows; other columns may
have any names and pass through where whole rows are returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.base import packed, shuffle_width, written

#: Bits of the node number settled in one round: 8 partners exchange and merge at a time.
STEP = 3
#: The white-space characters that do not count.
SPACE = "[\\x20\\x09-\\x0D]+"
#: What has to agree before two run rows are one.
VERIFIED = ["digest", "sha", "n_bytes"]


def _rows(docs: DataFrame, id: str, text: str, whole: bool, leaves: int) -> DataFrame:
    """The narrow rows that the merge works on; ``leaf`` and ``rid`` are fixed once written."""
    inner = packed(docs).withColumn("text", F.coalesce(F.col(f"row.`{text}`").cast("string"), F.lit("")))
    kept = [F.col("row")] if whole else []
    return (inner.withColumn("plain", F.regexp_replace("text", SPACE, ""))
            .select(F.pmod(F.spark_partition_id(), F.lit(leaves)).alias("leaf"),
                    F.monotonically_increasing_id().alias("rid"), F.col(f"row.`{id}`").alias("id"),
                    F.char_length("text").cast("long").alias("points"), F.xxhash64("plain").alias("digest"),
                    F.unhex(F.sha2("plain", 256)).alias("sha"), F.octet_length("plain").alias("n_bytes"), *kept))


def _merged(runs: DataFrame, leaves: int) -> DataFrame:
    """Runs dealt to their ``node``, sorted and merged: one row a verified digest there."""
    return (runs.repartitionById(leaves, F.col("node")).sortWithinPartitions("node", *VERIFIED)
            .groupBy("node", *VERIFIED).agg(F.sum("size").alias("size"), F.min("best").alias("best")))


def _partner(node: Column, digest: Column, bits: int, low: int, width: int) -> Column:
    """``node`` with ``width`` bits from ``low`` on taken from the top ``bits`` bits of ``digest``."""
    mask = ((1 << width) - 1) << low
    top = F.shiftrightunsigned(digest, 64 - bits).cast("int")
    return node.bitwiseAND(F.lit(~mask)).bitwiseOR(top.bitwiseAND(F.lit(mask)))


def tree_merge(runs: DataFrame, bits: int, step: int = STEP) -> DataFrame:
    """Leaf ``runs`` (node, digest, sha, n_bytes, size, best) to one row for each verified digest."""
    low = bits
    while low:
        width = min(step, low)
        low -= width
        runs = _merged(runs.withColumn("node", _partner(F.col("node"), F.col("digest"), bits, low, width)), 1 << bits)
    return runs


def exact_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """A row for each row of ``docs``: id, keep_id, group_size, kept, sha; with ``row`` if ``whole``."""
    bits = max(0, (shuffle_width(docs.sparkSession) - 1).bit_length())
    rows = written(_rows(docs, id, text, whole, 1 << bits), "exact-rows")
    best = F.struct((-F.col("points")).alias("less"), F.col("id").isNull().alias("none"), "id", "rid")
    leaves = written(_merged(rows.select(F.col("leaf").alias("node"), *VERIFIED, F.lit(1).cast("long").alias("size"),
                                         best.alias("best")), 1 << bits), "exact-runs")
    heads = written(tree_merge(leaves, bits).select(*VERIFIED, "size", "best"), "exact-heads")
    answers = leaves.select(F.col("node").alias("leaf"), *VERIFIED).join(heads, VERIFIED)
    return (rows.join(answers, ["leaf", *VERIFIED])
            .select("id", F.col("best.id").alias("keep_id"), F.col("size").alias("group_size"),
                    (F.col("rid") == F.col("best.rid")).alias("kept"), F.lower(F.hex("sha")).alias("sha"),
                    *(["row"] if whole else [])))


def without_copies(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with its columns."""
    return exact_copies(docs, id, text, whole=True).filter("kept").select("row.*")


def op12(docs: DataFrame) -> DataFrame:
    return exact_copies(docs).select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                                     F.col("sha").alias("text_sha256"))
