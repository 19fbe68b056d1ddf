"""What the stateful operators of a query hold, read from its checkpoint.

Spark's state data source reads the state as of the last committed micro-batch; a join has a store
for each side.  For looking, and for proving that state goes when the watermark passes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

JOIN = "symmetricHashJoin"
SIDES = ("left", "right")


def operators(spark: SparkSession, checkpoint: str) -> list[tuple[int, str]]:
    """(operator id, name) of the query's stateful operators."""
    rows = spark.read.format("state-metadata").load(checkpoint).select("operatorId", "operatorName").distinct()
    return sorted((r.operatorId, r.operatorName) for r in rows.collect())  # a handful


def held(spark: SparkSession, checkpoint: str, operator: int, side: str | None = None) -> DataFrame:
    """The rows that an operator holds: struct columns ``key`` and ``value``, and the partition."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    return (reader.option("joinSide", side) if side else reader).load(checkpoint)


def counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(operator_id, operator, side, rows) over all stateful operators of a query."""
    found = None
    for operator, name in operators(spark, checkpoint):
        for side in SIDES if name == JOIN else (None,):
            rows = held(spark, checkpoint, operator, side).agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(operator).alias("operator_id"), F.lit(name).alias("operator"),
                F.lit(side).cast("string").alias("side"), "rows")
            found = rows if found is None else found.unionByName(rows)
    return found if found is not None else spark.createDataFrame(
        [], "operator_id int, operator string, side string, rows long")
