"""How many orders are in which state now, kept by deltas: an order that changes takes back its old state.

``completion_stream`` counts state *rows*: an order that failed and was then completed counts once in
each.  Counted by *order*, its failed row has to be retracted when the completed one comes.  The state
kept for an order is its latest status and the time of its decision; it emits +1 for a new status and
-1 for the one it had.  An order's states are decided within two windows of it, so the watermark
ends its state (a timer); rows that come twice, or decisions older than the known one, change nothing.
The orders of a slot (``slots``) share a call and a state row.

Summed, the deltas are the statuses of the batch ``current_state``.  Each micro-batch stores its sums
under its query and number, so a replayed one counts once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import contract as C
from ..functions.times import interval_seconds
from ..operators import metrics as me
from ..operators import states as st
from . import jobs, sinks
from .slots import SLOTS, slot

ROW = ["order_id", "ordered", "decided", "state_id", "order_status"]
LATEST = ("order_id array<string>, decided array<long>, state_id array<string>, order_status array<string>, "
          "ends array<long>")
DELTAS = "order_id string, order_status string, change long"


def status_changes(states: DataFrame, within: str = C.CORRELATION_WINDOW, lateness: str = C.WATERMARK_DELAY,
                   slots: int = SLOTS) -> DataFrame:
    """Streaming history rows -> (order_id, order_status, change)."""
    reach = 2 * interval_seconds(within) * 1000

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs()
        known = {order: (tuple(row), ends) for order, *row, ends in zip(*state.get, strict=True)} if state.exists else {}
        latest, reaches, out = {}, {}, []
        for part in parts:
            for order, ordered, *row in zip(*(part[c].tolist() for c in ROW), strict=True):
                latest[order] = max(tuple(row), latest.get(order, ()))
                reaches[order] = max(ordered // 1000 + reach, reaches.get(order, watermark + 1))
        for order, row in latest.items():
            was = known[order][0] if order in known else None
            now = row if was is None else max(row, was)
            if was is None or was[2] != now[2]:
                out += [(order, now[2], 1)] + ([(order, was[2], -1)] if was else [])
            known[order] = now, reaches[order]
        left = [(order, *row, ends) for order, (row, ends) in known.items() if ends >= watermark]
        if left:
            columns = [list(c) for c in zip(*left, strict=True)]
            state.update(tuple(columns))
            state.setTimeoutTimestamp(max(min(columns[-1]), watermark + 1))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=["order_id", "order_status", "change"])

    decided = F.coalesce(st.DECIDED, "order_time")
    rows = (states.withColumn("at", decided).withWatermark("at", lateness)
            .select(slot("order_id", slots=slots), "order_id", "state_id", "order_status", "at",
                    F.unix_micros("at").alias("decided"), F.unix_micros("order_time").alias("ordered")))
    return rows.groupBy("slot").applyInPandasWithState(step, DELTAS, LATEST, "update", GroupStateTimeout.EventTimeTimeout)


def store_changes(path: str) -> Callable[..., None]:
    """Each batch's sums by status, under its query and number."""
    def run(batch: DataFrame, batch_id: int, query_id: str = "direct") -> None:
        sums = batch.groupBy("order_status").agg(F.sum("change").alias("change"))
        rows = sums.withColumns({"query": F.lit(query_id), "batch_id": F.lit(int(batch_id)).cast("long")})
        sinks.replace_partitions(rows, path, ["query", "batch_id"])

    return run


def run_order_changes(state_records: DataFrame, path: str, checkpoint: str, within: str = C.CORRELATION_WINDOW,
                      lateness: str = C.WATERMARK_DELAY, trigger: dict | None = None) -> StreamingQuery:
    """State records -> stored sums of status changes by order."""
    rows = st.history_rows(st.parse_states(state_records).drop("order_time_parsed"))
    return jobs._start(status_changes(rows, within, lateness), checkpoint, store_changes(path), mode="update", trigger=trigger)


def orders_by_status(spark: SparkSession, path: str) -> DataFrame:
    """(order_status, order_count) of all orders as they stand."""
    rows = spark.read.schema("order_status string, change long, query string, batch_id long").parquet(path)
    return (rows.groupBy("order_status").agg(F.sum("change").alias("order_count"))
            .filter("order_count <> 0"))


def completion_by_order(spark: SparkSession, path: str) -> DataFrame:
    """``metrics.completion_rate`` with orders instead of state rows."""
    return me.completion_rate_of_counts(orders_by_status(spark, path))
