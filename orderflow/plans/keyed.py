"""Keyed tables of immutable folders, named by a manifest that is replaced in one step.

Every write goes to a folder of its own; it joins the table when a new manifest names it.  A
manifest is a small JSON file ``_manifest/<version>``, written aside and renamed into place without
overwriting, so a version exists whole or not at all, two writers cannot make the same one (the
second reads again and repeats its change), and a reader works on the folders of one version
whatever is written, merged or replaced meanwhile.  Folders leave the disk only in ``expire``.

Rows are partitioned by a hash bucket of the key and sorted by it inside each file, with Bloom
filters on the key: a point lookup reads one bucket, and in it the row groups that may hold the key.

``merge`` says how rows of one key become one (it must not mind seeing a row twice).  Reads apply
it, and so does compaction: ``fan_in`` folders of one level become one folder of the next, so a row
is rewritten once a level, however many micro-batches the table took.

The rename has to be atomic (HDFS and local disks are); on a store without that, let one job write.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

#: Buckets of a new table; size it so that a bucket of the final table is a few files.
BUCKETS = 64
BUCKET, FOLDER = "order_bucket", "folder"
#: Folders of one level that are merged into one of the next.
FAN_IN = 16


def key_bucket(key: Column | str, buckets: int) -> Column:
    c = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")


class Files:
    """The few calls on the shared file system that the manifests need."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.jvm = spark, spark._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.system = self.path(path).getFileSystem(conf)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.system.getUri(), conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[tuple[str, int]]:
        """(name, time of change in ms) of what lies in ``folder``."""
        if not self.system.exists(self.path(folder)):
            return []
        return [(s.getPath().getName(), s.getModificationTime()) for s in self.system.listStatus(self.path(folder))]

    def read(self, name: str) -> str:
        return self.spark.read.text(name, wholetext=True).first()[0]

    def create(self, name: str, text: str) -> bool:
        """Put ``text`` at ``name`` in one step; False if somebody else was first."""
        aside = f"{name.rpartition('/')[0]}/.{uuid.uuid4().hex}"
        out = self.system.create(self.path(aside), False)
        out.write(bytearray(text.encode()))
        out.close()
        none = self.spark.sparkContext._gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            self.context.rename(self.path(aside), self.path(name), none)
        except Py4JJavaError as error:
            self.system.delete(self.path(aside), False)
            if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            return False
        return True

    def delete(self, name: str) -> None:
        self.system.delete(self.path(name), True)


@dataclass(frozen=True)
class Entry:
    """A live folder: where it is, who wrote it (a replay replaces its own), how often it was merged."""

    folder: str
    writer: str
    level: int = 0


@dataclass(frozen=True)
class Snapshot:
    version: int
    buckets: int
    schema: StructType
    entries: tuple[Entry, ...]


class KeyedTable:
    """A table at ``path`` with one row per key after ``merge``."""

    def __init__(self, path: str, merge: Callable[[DataFrame], DataFrame], key: str = "order_id", buckets: int = BUCKETS):
        self.path, self.merge, self.key, self.buckets = path.rstrip("/"), merge, key, buckets

    # ------------------------------------------------------------------------- versions
    def snapshot(self, spark: SparkSession) -> Snapshot | None:
        """The latest version, or None where there is no table yet."""
        while True:
            files = Files(spark, self.path)
            versions = [int(n) for n, _ in files.names(f"{self.path}/_manifest") if n.isdigit()]
            if not versions:
                return None
            try:
                doc = json.loads(files.read(f"{self.path}/_manifest/{max(versions):020d}"))
            except AnalysisException as error:  # expired between the two calls: there is a later one
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
                continue
            return Snapshot(max(versions), doc["buckets"], StructType.fromJson(doc["schema"]),
                            tuple(Entry(**e) for e in doc["entries"]))

    def _commit(self, spark: SparkSession, schema: StructType, buckets: int,
                change: Callable[[tuple[Entry, ...]], list[Entry] | None]) -> bool:
        """Make the next version from ``change`` of the latest; again if another writer was faster."""
        while True:
            last = self.snapshot(spark)
            entries = change(last.entries if last else ())
            if entries is None:
                return False
            doc = {"buckets": last.buckets if last else buckets, "schema": (last.schema if last else schema).jsonValue(),
                   "entries": [vars(e) for e in entries]}
            if Files(spark, self.path).create(f"{self.path}/_manifest/{(last.version + 1) if last else 0:020d}", json.dumps(doc)):
                return True

    # ------------------------------------------------------------------------- writing
    def _write(self, rows: DataFrame, buckets: int, derive: Callable[[DataFrame], DataFrame] | None = None) -> str:
        """``rows`` to a new folder; REBALANCE lets AQE split a bucket that one key makes large.
        ``derive`` makes the table's rows of them after that shuffle, a row of each."""
        folder = f"data/{FOLDER}={uuid.uuid4().hex}"
        moved = rows.withColumn(BUCKET, key_bucket(self.key, buckets)).hint("rebalance", BUCKET)
        if derive is not None:
            moved = derive(moved).withColumn(BUCKET, key_bucket(self.key, buckets))
        (moved.sortWithinPartitions(BUCKET, self.key).write.partitionBy(BUCKET)
         .option("compression", "zstd").option(f"parquet.bloom.filter.enabled#{self.key}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
         .parquet(f"{self.path}/{folder}"))
        return folder

    def _buckets(self, spark: SparkSession) -> int:
        """A table that exists keeps its own number."""
        last = self.snapshot(spark)
        return last.buckets if last else self.buckets

    def append(self, rows: DataFrame, writer: str) -> None:
        """Add ``rows``; what the same ``writer`` (a query and its batch) added before is replaced."""
        spark, buckets = rows.sparkSession, self._buckets(rows.sparkSession)
        new = Entry(self._write(rows, buckets), writer)
        self._commit(spark, rows.schema, buckets, lambda old: [e for e in old if e.writer != writer] + [new])

    def replace(self, rows: DataFrame, derive: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """``rows``, or what ``derive`` makes of them row by row, are the table from now on."""
        spark, buckets = rows.sparkSession, self._buckets(rows.sparkSession)
        new = Entry(self._write(rows, buckets, derive), uuid.uuid4().hex)
        self._commit(spark, (derive(rows) if derive else rows).schema, buckets, lambda old: [new])

    def compact(self, spark: SparkSession, fan_in: int = FAN_IN) -> int:
        """Merge every ``fan_in`` folders of a level (all there are if ``fan_in`` is 1); -> merges made.

        A merge whose folders were replaced meanwhile (a replay, another compaction) is given up.
        What merges left behind goes once its grace is over.
        """
        made = 0
        while (last := self.snapshot(spark)) is not None:
            if fan_in == 1:
                group = list(last.entries) if len(last.entries) > 1 else []
            else:
                levels = [e.level for e in last.entries]
                full = [n for n in sorted(set(levels)) if levels.count(n) >= fan_in]
                group = [e for e in last.entries if full and e.level == full[0]][:fan_in]
            if not group:
                break
            merged = Entry(self._write(self.merge(self._rows(spark, last, group)), last.buckets), uuid.uuid4().hex,
                           max(e.level for e in group) + 1)
            gone = set(group)
            if not self._commit(spark, last.schema, last.buckets, lambda old, gone=gone, merged=merged: (
                    [e for e in old if e not in gone] + [merged]) if gone <= set(old) else None):
                break
            made += 1
        if made:
            self.expire(spark)
        return made

    def expire(self, spark: SparkSession, keep: int = 2, grace_seconds: float = 24 * 3600) -> list[str]:
        """Delete manifests but the last ``keep``, and folders older than ``grace_seconds`` that none of
        those names.  Readers of an older version, and writes under way, need the grace."""
        files = Files(spark, self.path)
        versions = sorted(int(n) for n, _ in files.names(f"{self.path}/_manifest") if n.isdigit())
        named = set()
        for version in versions[-keep:]:
            named |= {e["folder"] for e in json.loads(files.read(f"{self.path}/_manifest/{version:020d}"))["entries"]}
        for version in versions[:-keep]:
            files.delete(f"{self.path}/_manifest/{version:020d}")
        before = (time.time() - grace_seconds) * 1000
        old = [f"data/{n}" for n, changed in files.names(f"{self.path}/data") if changed <= before and f"data/{n}" not in named]
        for folder in old:
            files.delete(f"{self.path}/{folder}")
        return old

    # ------------------------------------------------------------------------- reading
    def _rows(self, spark: SparkSession, snapshot: Snapshot, entries: list[Entry] | None = None, bucket: bool = False) -> DataFrame:
        chosen = snapshot.entries if entries is None else entries
        schema = StructType([*snapshot.schema.fields]).add(FOLDER, StringType()).add(BUCKET, IntegerType())
        rows = (spark.read.schema(schema).option("basePath", f"{self.path}/data")
                .parquet(*[f"{self.path}/{e.folder}" for e in chosen]) if chosen else spark.createDataFrame([], schema))
        return rows.drop(FOLDER) if bucket else rows.drop(FOLDER, BUCKET)

    def _latest(self, spark: SparkSession) -> Snapshot:
        last = self.snapshot(spark)
        if last is None:
            raise ValueError(f"no table at {self.path}")
        return last

    def read(self, spark: SparkSession, snapshot: Snapshot | None = None) -> DataFrame:
        """The table, one row per key, as of ``snapshot`` (the latest version by default)."""
        return self.merge(self._rows(spark, snapshot or self._latest(spark)))

    def lookup(self, spark: SparkSession, value: str) -> DataFrame:
        """The rows of one key: the literal's bucket is constant-folded, so one partition is read, and
        the equality reaches the files' statistics and Bloom filters."""
        last = self._latest(spark)
        rows = self._rows(spark, last, bucket=True).filter(
            (F.col(BUCKET) == key_bucket(F.lit(value), last.buckets)) & (F.col(self.key) == value))
        return self.merge(rows.drop(BUCKET))

    def lookup_many(self, spark: SparkSession, keys: DataFrame) -> DataFrame:
        """The rows of the keys of a table: only buckets that hold one of them are read (a subquery on
        the partition column, at most as many values as buckets), then a semi-join on the key."""
        last = self._latest(spark)
        wanted = keys.select(F.col(self.key))
        buckets = wanted.select(key_bucket(self.key, last.buckets).alias(BUCKET)).agg(F.collect_set(BUCKET)).scalar()
        rows = self._rows(spark, last, bucket=True).filter(F.array_contains(buckets, F.col(BUCKET)))
        return self.merge(rows.drop(BUCKET).join(wanted, self.key, "left_semi"))
