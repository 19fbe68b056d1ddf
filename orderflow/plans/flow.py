"""The batch flow over the given tables, stage by stage.

``EventFlow`` names each stage of the integrated pipeline as a lazy DataFrame over the
``orders`` table of a data folder:

    topic rows -> classified -> valid -> timed -> unique -> domains -> correlated -> states

Nothing is collected or cached here; each query builds only the stages it needs and Catalyst
prunes the rest (e.g. a count by code never materialises the payload).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import correlate as corr
from ..operators import dedup as dd
from ..operators import states as st
from ..operators import validate as va
from ..session import pin_utc
from ..sources.eventlog import derive_event_log
from ..sources.tables import read_table

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


#: ``orders`` rows for one task that derives, parses and sorts their log: about 270,000 events, 100 MB.
ROWS_PER_TASK = 100_000


def dealt(orders: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``orders`` in tasks of at most about ``rows_per_task``.

    A row of ``orders`` becomes events of twenty times its size in its file, so splits of the file's
    bytes make tasks whose sorts do not fit into memory.  Tables whose splits are small stay as they are.
    """
    tasks = -(-orders.count() // rows_per_task)
    return orders.repartition(tasks) if tasks > orders.rdd.getNumPartitions() else orders


UNIQUE_COLUMNS = ["event_id", "event_timestamp", "topic", "partition", "offset", "kafka_key",
                  "event_type", "order_id", "customer_id", "payload"]


class EventFlow:
    """Lazy stages of the integrated pipeline over one data folder.

    ``splits`` deals the ``orders`` rows into that many tasks before the log is derived and parsed: a
    file with one row group is read by one task.  Without it, ``dealt`` sizes the tasks by their rows.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, splits: int | None = None):
        self.spark = pin_utc(spark)
        self.sf_dir, self.splits = sf_dir, splits

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    @cached_property
    def topic_rows(self) -> DataFrame:
        orders = self.table("orders")
        return derive_event_log(orders.repartition(self.splits) if self.splits else dealt(orders))

    @cached_property
    def classified(self) -> DataFrame:
        return va.validate(self.topic_rows)

    @cached_property
    def valid(self) -> DataFrame:
        return va.valid_events(va.classify(va.parse_events(self.topic_rows, once=True)))

    @cached_property
    def timed(self) -> DataFrame:
        """Valid events with a parseable event time (job 2's input filter)."""
        return dd.with_event_time(self.valid)

    @cached_property
    def unique(self) -> DataFrame:
        """Technical duplicates removed (one row per event_id).

        Only the columns later stages read go into the dedup (the raw text, the corrupt
        column and the validation verdict stay behind): the kept-row struct is built inside
        an aggregate, where the optimizer cannot prune it, and it is what crosses the shuffle.
        """
        return dd.dedup(self.timed.select(*UNIQUE_COLUMNS))

    @cached_property
    def domains(self):
        return corr.split_domains(self.unique)

    def correlated(self, shape: str | None = None) -> DataFrame:
        o, p, i = self.domains
        return corr.correlate(o, p, i, shape=shape)

    @cached_property
    def states(self) -> DataFrame:
        return st.order_status(self.correlated())

    @cached_property
    def history(self) -> DataFrame:
        return st.history_rows(st.order_status(self.correlated(), with_decision=True))

    def expected_states(self) -> DataFrame:
        """The load mix as an expectations table, derived from ``orders`` by the same rule."""
        k = F.col("o_orderkey")
        return self.table("orders").select(
            F.concat(F.lit("ORD-"), F.lpad(k.cast("string"), 9, "0")).alias("order_id"),
            F.when(k % 20 < 15, F.lit("COMPLETED")).when(k % 20 < 18, F.lit("PAYMENT_FAILED"))
            .otherwise(F.lit("INVENTORY_REJECTED")).alias("expected_status"))
