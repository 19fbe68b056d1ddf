"""Connected components of links, by alternating large-star and small-star rounds on Spark.

Every round is two aggregate-and-join steps over the links, written to the shared checkpoint
folder; only two numbers a round come to the driver, to see whether anything changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.base import written


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.filter("b > a").join(least, "a").filter("b != m")
            .select(F.col("m").alias("a"), "b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    # links are (a < b); the smaller neighbours of b and b itself go to the least of them
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    return (links.join(least, "b").select(F.col("m").alias("u"), F.explode(F.array("a", "b")).alias("v"))
            .filter("u != v").select(F.col("u").alias("a"), F.col("v").alias("b")).distinct())


def components(links: DataFrame, name: str) -> DataFrame:
    """``links`` (a, b), any order -> (node, component) for every linked node.

    ``component`` is the least node reachable.  A node without links has no row.
    """
    edges = written(links.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .distinct(), name)
    state = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == state or not mark[0]:
            break
        state = tuple(mark)
        edges = written(_small_star(_large_star(edges)), name)
    return (edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
            .union(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()))
