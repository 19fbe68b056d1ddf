"""Windowed counts and rates (batch or streaming, the same functions).

All are aggregates with map-side partial aggregation: a hot window or key is combined before
the shuffle.  On streams, windows carry a watermark and run in update or append mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contract as C


def _watermarked(df: DataFrame, ts: str, lateness: str | None) -> DataFrame:
    if df.isStreaming and lateness is not None:
        return df.withWatermark(ts, lateness)
    return df


def window_counts(events: DataFrame, ts: str = "event_timestamp", width: str = C.VOLUME_WINDOW,
                  by: tuple[str, ...] = ("order_id",), lateness: str | None = C.WATERMARK_DELAY,
                  count_name: str = "event_count") -> DataFrame:
    """Rows per (tumbling window, *by)."""
    w = F.window(F.col(ts), width)
    return (_watermarked(events, ts, lateness)
            .groupBy(w.alias("window"), *by)
            .agg(F.count(F.lit(1)).alias(count_name))
            .select(*by, F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"), count_name))


def order_volume(orders: DataFrame, ts: str = "event_timestamp", width: str = C.VOLUME_WINDOW,
                 lateness: str | None = C.WATERMARK_DELAY) -> DataFrame:
    """Orders per tumbling window: (window_start, window_end, order_count)."""
    return window_counts(orders, ts, width, (), lateness, "order_count")


def payment_failure_rate(payments: DataFrame, ts: str = "event_timestamp",
                         width: str = C.RATE_WINDOW,
                         lateness: str | None = C.WATERMARK_DELAY) -> DataFrame:
    """Per window: payments, failed payments and failed / all x 100 (2 decimals)."""
    w = F.window(F.col(ts), width)
    failed = F.count_if(F.col("event_type") == C.PAYMENT_FAILED)
    total = F.count(F.lit(1))
    return (_watermarked(payments, ts, lateness)
            .groupBy(w.alias("window"))
            .agg(total.alias("payment_count"), failed.alias("failed_count"))
            .select(F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"), "payment_count", "failed_count",
                    F.round(F.col("failed_count") * F.lit(100.0) / F.col("payment_count"), 2)
                    .alias("failure_rate_pct")))


def completion_rate(states: DataFrame) -> DataFrame:
    """completed / final states x 100, 2 decimals, 0.0 when there is no final state.

    Counts the rows it is given: state rows (an order that failed and was then completed is two of
    them), or with ``states.current_state`` orders.  One global aggregate (partial per task, one
    final row).
    """
    return completion_rate_of_counts(states.select("order_status", F.lit(1).cast("long").alias("order_count")))


def completion_rate_of_counts(counts: DataFrame) -> DataFrame:
    """The same from (order_status, order_count) rows."""
    def counted(*statuses: str):
        of = F.when(F.col("order_status").isin(*statuses), F.col("order_count"))
        return F.coalesce(F.sum(of), F.lit(0)).cast("long")

    agg = counts.agg(counted(C.COMPLETED).alias("completed"), counted(C.PAYMENT_FAILED_STATE).alias("payment_failed"),
                     counted(C.INVENTORY_REJECTED_STATE).alias("inventory_rejected"),
                     counted(*C.FINAL_STATUSES).alias("final_orders"))
    return agg.withColumn(
        "completion_rate_pct",
        F.when(F.col("final_orders") > 0,
               F.round(F.col("completed") * F.lit(100.0) / F.col("final_orders"), 2))
        .otherwise(F.lit(0.0)))


def time_span(events: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """Oldest / newest event time and their spread in seconds."""
    return (events.agg(F.min(ts).alias("oldest"), F.max(ts).alias("newest"),
                       F.count(F.lit(1)).alias("event_count"))
            .withColumn("spread_seconds",
                        F.unix_seconds(F.col("newest")) - F.unix_seconds(F.col("oldest"))))


def metric_rows(orders: DataFrame, payments: DataFrame, states_with_time: DataFrame,
                ts: str = "event_timestamp") -> DataFrame:
    """Durable metric rows keyed ``(metric_name, window_start, window_end)`` in long form.

    orders_per_minute, order_volume_5m, payment_failure_rate_5m and completion_rate_5m (by
    the window of the order time).  ``states_with_time`` needs ``order_status`` and a
    timestamp column ``order_ts``.
    """
    minute_counts = window_counts(orders, ts, C.MINUTE_WINDOW, (), None, "v")
    per_minute = minute_counts.select(
        F.lit("orders_per_minute").alias("metric_name"), "window_start", "window_end",
        F.col("v").cast("double").alias("metric_value"))
    # roll the 5-minute volume up from the per-minute counts (epoch-aligned minutes nest in
    # 5-minute windows): one pass over the orders instead of two
    w5 = F.window(F.col("window_start"), C.VOLUME_WINDOW)
    volume = (minute_counts.groupBy(w5.alias("w")).agg(F.sum("v").alias("v"))
              .select(F.lit("order_volume_5m").alias("metric_name"),
                      F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      F.col("v").cast("double").alias("metric_value")))
    failure = payment_failure_rate(payments, ts, C.RATE_WINDOW, None).select(
        F.lit("payment_failure_rate_5m").alias("metric_name"), "window_start", "window_end",
        F.col("failure_rate_pct").alias("metric_value"))
    final = states_with_time.filter(F.col("order_status").isin(*C.FINAL_STATUSES))
    w = F.window(F.col("order_ts"), C.RATE_WINDOW)
    completion = (final.groupBy(w.alias("window"))
                  .agg(F.count_if(F.col("order_status") == C.COMPLETED).alias("c"),
                       F.count(F.lit(1)).alias("n"))
                  .select(F.lit("completion_rate_5m").alias("metric_name"),
                          F.col("window.start").alias("window_start"),
                          F.col("window.end").alias("window_end"),
                          F.round(F.col("c") * F.lit(100.0) / F.col("n"), 2).alias("metric_value")))
    return per_minute.unionByName(volume).unionByName(failure).unionByName(completion)
