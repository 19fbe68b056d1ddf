"""Reading the given parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """One table of a data folder.  The scan's splits follow ``spark.sql.files.maxPartitionBytes``
    and the files' row groups; no shuffle is added to it."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
