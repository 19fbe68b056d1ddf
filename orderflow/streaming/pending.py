"""Orders whose wait is over, from the stream: state per order with an event-time timer.

An order waits for a payment until ``within`` after it, or, once payments are authorized, for an
inventory result until ``within`` after the last of them.  When the watermark passes that time
without a state, the order is emitted once, as ``audit.pending_orders`` names it (EXPIRED, with the
reason).  A chain of outer joins cannot say that: each join's output watermark lags by its window,
so the second reason would come a window late, and an order with several payments once for each.

Waits are kept by (order id, bucket of the order's time).  Payments and inventory results go to
the buckets of all orders that they may belong to, which repeats the few that lie within a window of
a bucket's start.  So one order id with any share of the rows is dealt over its time, and a bucket's
waits shrink with the watermark: resolved and expired orders go, and so do times that no order
still to come can need.  Only kinds and times are kept.  The waits of a slot (``slots``) share a call
and a state row.

This is the one operator of the core that runs Python on events: built-in joins and aggregates have
no timers.  Rows go through it as Arrow batches, narrowed to a kind and a time.

Several order events of one id each wait by themselves; the batch report lets any state of the id
resolve them all.  Rows behind the watermark are dropped, as in every stateful operator.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import contract as C
from ..functions.times import interval_seconds, time_bucket
from .slots import SLOTS, slot

#: Width of the order-time buckets that a hot order id is dealt over.
SPREAD = "2 hours"
#: What of an event matters here, and how many windows after its order it may come.
KINDS = [((C.ORDER_CREATED,), 0), ((C.PAYMENT_AUTHORIZED,), 1), ((C.PAYMENT_FAILED,), 1), (C.INVENTORY_TYPES, 2)]

WAITS = "order_id array<string>, bucket array<long>, kind array<int>, at array<long>"
WAIT = ["order_id", "bucket", "kind", "at"]
EXPIRED = "order_id string, order_time timestamp, pending_reason string, pending_status string"


def expired(waits: list[list[int]], within: int, watermark: int) -> tuple[list[tuple[int, str]], list[list[int]], int | None]:
    """What a watermark does to the waits of one group (times in microseconds, watermark in ms).

    -> (expired orders with their reason, the waits that stay, the time to look again in ms or None).
    """
    orders, authorized, failed, inventory = waits
    out, open_orders, deadlines = [], [], []
    for at in orders:
        paid = [t for t in authorized if at <= t <= at + within]
        if any(at <= t <= at + within for t in failed) or any(t <= i <= t + within for t in paid for i in inventory):
            continue  # the order has a state
        deadline = max(paid, default=at) + within
        if deadline // 1000 < watermark:
            out.append((at, "AWAITING_INVENTORY" if paid else "AWAITING_PAYMENT"))
        else:
            open_orders.append(at)
            deadlines.append(deadline // 1000)
    # orders still to come are not behind the watermark, and nothing that matters to them is
    needed = min([watermark * 1000, *open_orders])
    rest = [[t for t in times if t >= needed] for times in (authorized, failed, inventory)]
    ahead = deadlines or [max(t) // 1000 for t in rest if t]
    look = max(min(ahead), watermark + 1) if ahead else None
    return out, [open_orders, *rest], look


def expired_orders(events: DataFrame, within: str = C.CORRELATION_WINDOW, lateness: str = C.WATERMARK_DELAY,
                   spread: str = SPREAD, slots: int = SLOTS) -> DataFrame:
    """Streaming events (order_id, event_type, event_timestamp) -> orders whose wait is over."""
    width, bucket = interval_seconds(within), interval_seconds(spread)

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        waits, watermark = {}, state.getCurrentWatermarkMs()
        known = [state.get] if state.exists else []
        for columns in chain(known, ([part[c].tolist() for c in WAIT] for part in parts)):
            for order, of, kind, at in zip(*columns, strict=True):
                if (order, of) not in waits:
                    waits[order, of] = [[], [], [], []]
                waits[order, of][kind].append(at)
        over, left, looks = [], [], []
        for (order, of), times in waits.items():
            out, times, look = expired(times, width * 1_000_000, watermark)
            over += [(order, at, why) for at, why in out]
            left += [(order, of, kind, at) for kind, ats in enumerate(times) for at in ats]
            looks += [] if look is None else [look]
        if left:
            state.update(tuple(list(c) for c in zip(*left, strict=True)))
            state.setTimeoutTimestamp(min(looks))
        elif state.exists:
            state.remove()
        if over:
            orders, ats, reasons = zip(*over, strict=True)
            yield pd.DataFrame({"order_id": orders, "order_time": pd.to_datetime(list(ats), unit="us"),
                                "pending_reason": reasons, "pending_status": "EXPIRED"})

    kind, reach = F.lit(None).cast("int"), F.lit(0)
    for i, (types, windows) in enumerate(KINDS):
        of = F.col("event_type").isin(*types)
        kind, reach = F.when(of, F.lit(i)).otherwise(kind), F.when(of, F.lit(windows * width)).otherwise(reach)
    at = F.col("event_timestamp")
    rows = (events.withWatermark("event_timestamp", lateness).withColumn("kind", kind)
            .filter(F.col("kind").isNotNull() & F.col("order_id").isNotNull())
            .select("order_id", "kind", "event_timestamp", F.unix_micros(at).alias("at"),
                    F.explode(F.sequence(time_bucket(at - F.make_dt_interval(secs=reach.cast("decimal(18,6)")), bucket),
                                         time_bucket(at, bucket))).alias("bucket"))
            .withColumn("slot", slot("order_id", "bucket", slots=slots)))
    return rows.groupBy("slot").applyInPandasWithState(
        step, EXPIRED, WAITS, "append", GroupStateTimeout.EventTimeTimeout)


def run_pending(records: DataFrame, path: str | dict, checkpoint: str, within: str = C.CORRELATION_WINDOW,
                lateness: str = C.WATERMARK_DELAY, trigger: dict | None = None) -> StreamingQuery:
    """Unique ``(key, value)`` events -> a log of expired orders."""
    from . import jobs  # jobs drives this module from the command line

    return jobs._start(expired_orders(jobs._events(records), within, lateness), checkpoint, trigger=trigger,
                       target=jobs._target(path))
