"""Batch backfill: the whole pipeline over a bounded topic log, stage by stage, to tables.

Each stage is written as a parquet table under one root in the shared checkpoint folder and
the next stage reads that table: the written tables cut lineage (a lost executor recomputes
one stage, not the pipeline), and each is a durable intermediate log like the streaming
stages'.  The history is a keyed table (``plans.keyed``): a run makes its next version, which holds
this run's states alone, and a point lookup reads one bucket, like a partition-key read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contract as C
from ..operators import correlate as corr
from ..operators import dedup as dd
from ..operators import states as st
from ..operators import validate as va
from ..session import pin_utc, scratch_path
from . import history as hi
from .flow import UNIQUE_COLUMNS

#: Codec of the stage tables, which are written once and read a few times.
CODEC = "zstd"


@dataclass
class BackfillTables:
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def run_backfill(spark: SparkSession, topic_rows: DataFrame, root: str | None = None,
                 buckets: int = hi.BUCKETS) -> BackfillTables:
    """validated + dead letters -> unique events -> states -> keyed history, as tables."""
    pin_utc(spark)
    t = BackfillTables(root or scratch_path(spark, "backfill"))
    classified = va.validate(topic_rows)
    # stage 1: one pass over the log; the verdict is kept with the parsed row
    (classified.select(*va.TOPIC_FIELDS, "event_id", "event_type", "event_time", "order_id",
                       "customer_id", "payload", "validation_error", "validation_status")
     .write.mode("overwrite").partitionBy("validation_status").option("compression", CODEC).parquet(t.path("validated")))
    validated = spark.read.parquet(t.path("validated"))
    (va.dead_letter_records(validated.filter(F.col("validation_status") == C.INVALID))
     .write.mode("overwrite").option("compression", CODEC).parquet(t.path("dead_letters")))
    # stage 2: valid rows only (partition pruning on validation_status), dedup
    timed = dd.with_event_time(validated.filter(F.col("validation_status") == C.VALID))
    (dd.dedup(timed.select(*UNIQUE_COLUMNS))
     .write.mode("overwrite").option("compression", CODEC).parquet(t.path("unique")))
    unique = spark.read.parquet(t.path("unique"))
    # stage 3: correlate and derive states
    o, p, i = corr.split_domains(unique)
    states = st.order_status(corr.correlate(o, p, i), with_decision=True)
    states.write.mode("overwrite").option("compression", CODEC).parquet(t.path("states"))
    # stage 4: keyed history, one row per (order_id, state_id), bucketed by order_id; equal states are
    # made one by their columns, before they have ids
    hi.write_states(st.distinct_states(spark.read.parquet(t.path("states"))), t.path("history"), buckets)
    write_report(spark, t)
    return t


def write_report(spark: SparkSession, t: BackfillTables) -> None:
    """Row counts per stage as ``(stage, row_count)`` rows, computed from the written tables
    (no stage is recomputed)."""
    validated = read_table(spark, t, "validated")
    rows = validated.select(F.expr(
        "stack(3, 'topic_rows', 1L, 'valid_events', "
        f"CASE WHEN validation_status = '{C.VALID}' THEN 1L ELSE 0L END, 'invalid_events', "
        f"CASE WHEN validation_status = '{C.INVALID}' THEN 1L ELSE 0L END) AS (stage, n)"))
    for name in ("unique", "states", "history"):
        rows = rows.unionByName(read_table(spark, t, name)
                                .select(F.lit(f"{name}_rows").alias("stage"), F.lit(1).cast("long").alias("n")))
    (rows.groupBy("stage").agg(F.sum("n").alias("row_count"))
     .write.mode("overwrite").parquet(t.path("report")))


def read_table(spark: SparkSession, tables: BackfillTables, name: str) -> DataFrame:
    return hi.read(spark, tables.path(name)) if name == "history" else spark.read.parquet(tables.path(name))


def lookup(spark: SparkSession, tables: BackfillTables, order_id: str) -> DataFrame:
    """Point lookup in the written history (``plans.history``)."""
    return hi.lookup(spark, tables.path("history"), order_id)
