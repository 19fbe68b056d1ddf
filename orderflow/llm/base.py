"""Helpers shared by the operators: written intermediates, global running totals, row keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderflow.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark's own reader (the path may be any store)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Cuts the lineage durably: a lost executor costs re-reading a file, not recomputing a chain,
    and a frame used by several later steps is computed once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key(column: str = "text") -> Column:
    """64-bit key of a text; a null text and an empty one have different keys."""
    return F.when(F.col(column).isNull(), F.lit(-1)).otherwise(F.xxhash64(F.col(column)))


def sampled(df: DataFrame, key: Column, n: int) -> DataFrame:
    """The rows of written ``df`` with the ``n`` smallest hashes of ``key``: a bounded sample.

    Only about twice as many rows as asked for, taken by hash, go into the final choice.
    """
    share = min(1.0, 2.0 * (n + 1000) / max(1, df.count()))
    hashed = df.withColumn("__hash", F.xxhash64(key))
    few = hashed.filter(F.shiftrightunsigned("__hash", 1) <= F.lit(min((1 << 63) - 1, int(share * 2.0 ** 63))))
    return few.orderBy("__hash").limit(n).drop("__hash")


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` as one struct column ``row``, so that no name of its columns can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def running_total(df: DataFrame, order: list[Column], value: str, total: str, name: str) -> DataFrame:
    """Add ``total``: the sum of ``value`` over all rows before this one in the global ``order``.

    The rows are range-partitioned by ``order`` and written with their range number, so ranges
    stay fixed; one row per range carries the ranges' sums, a window inside each range does the
    rest.  ``order`` must be (nearly) unique, or equal rows meet in one range.  ``df`` should be
    narrow and written (range partitioning samples it first).  Adds ``<total>_range`` as well.
    """
    spark = df.sparkSession
    part = f"{total}_range"
    ranged = written(
        df.repartitionByRange(shuffle_width(spark), *order).withColumn(part, F.spark_partition_id()),
        name)
    sums = ranged.groupBy(part).agg(F.sum(value).alias("_sum"))
    # one row per range: bounded by the shuffle width, whatever the input
    before = sums.select(part, F.coalesce(
        F.sum("_sum").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_before"))
    inside = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.join(F.broadcast(before), part)
            .withColumn(total, F.col("_before") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .drop("_before"))
