"""Event-time stage: parse event time, drop technical duplicates.

Streaming: ``withWatermark`` + ``dropDuplicatesWithinWatermark`` (state kept per key until the
watermark passes).  Batch: the same keep-one-per-key semantics without lateness, written as an
aggregate ``min(struct(order..., rest...))`` per key rather than ``row_number()``: the
aggregate is combined map-side before the shuffle, so a key that holds a third of all rows
costs one row per map task in the exchange instead of all its rows in one window task, and
the kept row is deterministic (total order on timestamp, topic, partition, offset).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contract as C
from ..functions.times import parse_event_time

DEFAULT_ORDER = ("event_timestamp", "topic", "partition", "offset")


def with_event_time(events: DataFrame, text_col: str = "event_time",
                    ts_col: str = "event_timestamp") -> DataFrame:
    """Add the parsed event time and drop rows whose time is absent or unparseable."""
    return (events.withColumn(ts_col, parse_event_time(text_col))
            .filter(F.col(ts_col).isNotNull()))


def extract_event_keys(records: DataFrame, value_col: str = "value") -> DataFrame:
    """Key + JSON text -> add event_id / event_time by JSON path, without a full parse."""
    return (records
            .withColumn("event_id", F.get_json_object(F.col(value_col), "$.event_id"))
            .withColumn("event_time", F.get_json_object(F.col(value_col), "$.event_time")))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the smallest by ``order`` (then by every other column).

    An aggregate, so partial aggregation collapses hot keys before the shuffle.
    """
    keys = list(keys)
    order = [c for c in order if c in df.columns and c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest]).alias("_first")
    return (df.groupBy(*keys).agg(F.min(packed).alias("_first"))
            .select(*keys, *[F.col(f"_first.{c}").alias(c) for c in order + rest])
            .select(*df.columns))


def dedup(events: DataFrame, keys: Sequence[str] = ("event_id",), ts: str = "event_timestamp",
          lateness: str = C.WATERMARK_DELAY, order: Sequence[str] = DEFAULT_ORDER,
          spread: int | None = None) -> DataFrame:
    """Drop technical duplicates by ``keys``; streaming frames use the watermark.

    ``spread`` (streams only): a first ``dropDuplicatesWithinWatermark`` on ``keys`` + a salt
    taken from the source partition (``spark_partition_id() % spread``; a replayed micro-batch
    reads the same splits, so the salt is deterministic) spreads the copies of a hot key over
    up to ``spread`` state partitions; the second, on ``keys`` alone, then sees at most
    ``spread`` copies of any key within the watermark.  Still exactly one row per key.
    """
    if events.isStreaming:
        w = events.withWatermark(ts, lateness)
        if spread and spread > 1:
            w = (w.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(spread)))
                 .dropDuplicatesWithinWatermark(list(keys) + ["_salt"])
                 .drop("_salt"))
        return w.dropDuplicatesWithinWatermark(list(keys))
    return keep_first(events, keys, order)


# A business fact: an order has one event of a type per payment, and per SKU for inventory.
BUSINESS_KEY = ("order_id", "event_type", "payment_id", "sku")


def with_business_key(events: DataFrame) -> DataFrame:
    """Events + the payload's ``payment_id`` and ``sku`` (NULL where a type has none)."""
    return events.withColumns({"payment_id": F.col("payload.payment_id"), "sku": F.col("payload.sku")})
