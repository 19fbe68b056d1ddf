"""Event-time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_event_time(text: Column | str) -> Column:
    """ISO-8601 text -> TIMESTAMP, NULL when unparseable.

    ``try_to_timestamp`` rather than ``to_timestamp``: under ANSI mode (the Spark 4 default)
    ``to_timestamp('garbage')`` raises and would fail the whole job, while the contract is to
    drop such events.  An offset in the text is honoured; text without one takes the session
    zone (pinned to UTC).
    """
    c = F.col(text) if isinstance(text, str) else text
    return F.try_to_timestamp(c)


def interval_seconds(text: str) -> int:
    """'15 minutes' -> 900 (units: second(s), minute(s), hour(s), day(s))."""
    n, unit = text.split()
    unit = unit.lower().rstrip("s")
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit]
    return int(float(n) * scale)


def interval(text: str) -> Column:
    return F.expr(f"INTERVAL {text}")


def time_bucket(ts: Column, width_seconds: int) -> Column:
    """Index of the ``width_seconds`` bucket holding ``ts`` (epoch-aligned, exact integer)."""
    micros = F.unix_micros(ts.cast("timestamp"))
    width = F.lit(width_seconds * 1_000_000).cast("long")
    # (m - pmod(m, w)) is an exact multiple of w, so the division is exact: floor division
    # on longs that is also right for times before the epoch.
    return ((micros - F.pmod(micros, width)) / width).cast("long")
