"""Session helpers: time zone pinning and the shared checkpoint folder.

Every job in this package works in UTC, as the event contract does (event times are ISO-8601
text with a ``Z`` suffix).  The checkpoint / intermediate folder is always taken from the
session's ``spark.checkpoint.dir`` so that on a cluster it is the shared folder the cluster
names; a local default is set only where the setting is absent (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import warnings

from pyspark.sql import SparkSession

UTC = "UTC"


def pin_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone to UTC (event-time text without an offset is read as UTC)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    A local master without one gets a temporary folder; on a cluster, where executors would not
    see a folder of the driver's machine, a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all of {master!r} share")
        root = tempfile.mkdtemp(prefix="orderflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one job's durable output."""
    return f"{checkpoint_root(spark)}/orderflow/{name}-{uuid.uuid4().hex[:12]}"


def local_session(app: str = "orderflow", cores: int | str = "*", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.driver.memory", os.environ.get("ORDERFLOW_DRIVER_MEMORY", "8g"))
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    pin_utc(spark)
    checkpoint_root(spark)
    return spark


def cluster_settings(input_bytes: int | None = None, partition_bytes: int = 256 << 20) -> dict:
    """SQL settings for a large deployment, sized from the input volume.

    * AQE on, with partition coalescing and skew-join splitting: joins and aggregates start
      from ``input / partition_bytes`` shuffle partitions and AQE merges the small ones and
      splits a partition a hot key makes large;
    * scan splits of ``partition_bytes``;
    * RocksDB state store with changelog checkpointing for the dedup / join / window state
      (state lives off-heap and each micro-batch uploads only its changes);
    * UTC session zone (event times are UTC text) and the default ``min`` watermark policy
      stated explicitly.
    """
    partitions = max(200, (input_bytes or 0) // partition_bytes)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.session.timeZone": UTC,
        "spark.sql.streaming.multipleWatermarkPolicy": "min",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }


def apply_settings(spark: SparkSession, settings: dict) -> SparkSession:
    """Apply runtime-settable SQL settings to a session (static ones belong in the builder).

    Note: the shuffle-partition count of a stateful streaming query is fixed by its first
    run's checkpoint.
    """
    for key, value in settings.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
        elif spark.conf.get(key, None) != value:
            warnings.warn(f"{key} is fixed when the session is built; it stays "
                          f"{spark.conf.get(key, None)!r}, not {value!r}", stacklevel=2)
    return spark
