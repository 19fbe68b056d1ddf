"""The corpus pipeline: documents through the training-data operators, stage by stage.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a frame
that is written as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderflow.llm import decontamination, mixing, near_copies, token_files, toxicity
from orderflow.llm.base import table, written
from orderflow.llm.queries import vocabulary
from orderflow.session import scratch_path


#: Chunks that a worker of the token stage remembers: few, as the workers still hold what earlier stages used.
KEPT_CHUNKS = 150_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model does not take for toxic."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_copies.without_copies(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files of the corpus, read back: one row per document kept."""
    return token_files.op7(docs, vocabulary("byte_bpe_50k.json"), scratch_path(spark, "pipeline-tokens"), KEPT_CHUNKS)


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies), ("decontamination", drop_benchmark),
          ("mixing", mix_sources), ("tokens", token_output)]

#: No SQL for the pipeline: fitted models, sketches and token files are beyond it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
