"""Slots: the hash groups in which the Python operators on state keep many keys together.

Spark hands a group to Python as frames of its own and stores one state row for it, which costs about
a millisecond however few rows the group has.  With a group for each order that is what a run over
many orders consists of; with a group for each slot of orders, the calls and state rows of a
micro-batch are at most ``SLOTS``, and the rest is work by row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Slots of a stateful Python operator; fixed by the first run of a checkpoint.  A slot's state holds the
#: open keys of all orders divided by this, so size it for some thousands of them.
SLOTS = 4096


def slot(*keys: Column | str, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int").alias("slot")
