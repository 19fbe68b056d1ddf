"""Position of each row inside its key, in a given order -- without one task per key.

``row_number() OVER (PARTITION BY key ORDER BY ...)`` sends every row of a key to one task; with a
key holding a third of the data that task holds a third of the data.  Here the rows are cut into
ranges of (key, order columns), whatever those hold: one second, equal times or null times are cut
by the later columns.  Rows are numbered inside (range, key) and moved up by the rows that earlier
ranges have of the key.  Only the first and last key of a range can cross into another one, so these
two counts a range are all that has to be added up along the ranges: twice as many rows as ranges.

A range holds about one share of the rows in ``ranges``, however the keys are spread.  Spark finds
the cuts by sampling, so the ranged rows are written once (to the session's checkpoint folder) and
everything after that reads the same ranges, also when tasks are run again.  Rows move twice, once
into the ranges and once into the numbering; nothing else that moves grows with the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

RANGE, EARLIER = "_range", "_earlier"


def ranged_rows(df: DataFrame, by: Sequence[str], ranges: int | None = None) -> DataFrame:
    """``df``, written, with the number of the range of ``by`` (nulls first) that each row lies in."""
    spark = df.sparkSession
    path = scratch_path(spark, "ranges")
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (df.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in by])
            .withColumn(RANGE, F.spark_partition_id()))
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def rows_in_earlier_ranges(rows: DataFrame, key: str) -> DataFrame:
    """(range, key, rows of the key in earlier ranges), for the first and last key of every range."""
    ends = rows.groupBy(RANGE).agg(F.min(F.struct(key)).alias("_first"), F.max(F.struct(key)).alias("_last"))
    # one row a range: bounded by their number
    at_an_end = F.col(key).eqNullSafe(F.col(f"_first.{key}")) | F.col(key).eqNullSafe(F.col(f"_last.{key}"))
    counts = (rows.select(RANGE, key).join(F.broadcast(ends), RANGE).filter(at_an_end)
              .groupBy(RANGE, key).agg(F.count(F.lit(1)).alias("_rows")))
    along = Window.partitionBy(key).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(F.col(RANGE).alias("_at"), F.col(key).alias("_key"),
                         F.coalesce(F.sum("_rows").over(along), F.lit(0)).alias(EARLIER))


def sequence_within(df: DataFrame, key: str, order: Sequence[str], name: str = "seq",
                    ranges: int | None = None) -> DataFrame:
    """``df`` + ``name``: 1-based position of each row within its ``key`` by ``order``.

    ``order`` must be a total order inside a key (add a unique column as the last tie-break); NULL
    keys form one key, NULLs come first.  ``ranges`` defaults to the session's shuffle partitions.
    """
    rows = ranged_rows(df, [key, *order], ranges)
    inside = Window.partitionBy(RANGE, key).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    earlier = F.broadcast(rows_in_earlier_ranges(rows, key))  # two rows a range at most
    return (rows.withColumn(name, F.row_number().over(inside))
            .join(earlier, (F.col(RANGE) == F.col("_at")) & F.col(key).eqNullSafe(F.col("_key")), "left")
            .select(*df.columns, (F.col(name) + F.coalesce(F.col(EARLIER), F.lit(0))).cast("long").alias(name)))
