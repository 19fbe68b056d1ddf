"""The history table and the current-state table, shared by the stream and the backfill.

Both are ``keyed.KeyedTable``s by ``order_id``.  The history has one row per ``(order_id,
state_id)``: equal keys carry equal states, so merging drops copies.  The current-state table has
one row per order, the state decided last: merging keeps the latest, so a decision that arrives
late, out of order or twice changes nothing that it should not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from ..operators import states as st
from . import keyed
from .keyed import BUCKET, BUCKETS, KeyedTable  # noqa: F401  (the layout's names)


def history(path: str, buckets: int = BUCKETS) -> KeyedTable:
    return KeyedTable(path, st.upsert_view, buckets=buckets)


def current(path: str, buckets: int = BUCKETS) -> KeyedTable:
    return KeyedTable(path, st.latest_state, buckets=buckets)


def order_bucket(order_id: Column | str, buckets: int) -> Column:
    return keyed.key_bucket(order_id, buckets)


def stored_buckets(spark: SparkSession, path: str) -> int | None:
    """The bucket count stored with a table, or None where there is no table yet."""
    last = history(path).snapshot(spark)
    return last.buckets if last else None


def write(rows: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """``rows`` are the history from now on; nothing of an earlier one stays."""
    history(path, buckets).replace(rows)


def write_states(states: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """The history of ``states`` (distinct ones): their ids, which hardly compress, are made after the
    rows are shuffled to their buckets."""
    history(path, buckets).replace(states, st.history_rows)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per ``(order_id, state_id)``."""
    return history(path).read(spark).select(*st.HISTORY_COLUMNS, st.DECIDED)


def lookup(spark: SparkSession, path: str, order_id: str) -> DataFrame:
    """All states of one order."""
    return history(path).lookup(spark, order_id).select("order_id", "order_status", "state_id")


def lookup_many(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """All states of the orders of a key table."""
    return history(path).lookup_many(spark, keys).select("order_id", "order_status", "state_id")


def compact(spark: SparkSession, path: str, target: str | None = None) -> None:
    """Merge the table's folders into one, in place or as a new table at ``target``."""
    if target is None:
        history(path).compact(spark, fan_in=1)
    else:
        write(read(spark, path), target, stored_buckets(spark, path) or BUCKETS)
