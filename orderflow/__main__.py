"""Job entry point: ``python -m orderflow <command>`` or ``spark-submit -m``-style wrappers.

Commands (the session comes from the cluster / ``spark-submit``; settings are applied with
``--input-bytes`` sizing when given):

* ``backfill --data DIR [--out ROOT] [--splits N]`` -- the batch pipeline over DIR/orders.parquet's
  event log, every stage written as a table under ROOT (default: the shared checkpoint folder); a
  second run on the same ROOT replaces the tables and makes the history's next version;
* ``pipeline --topics PATH | --kafka SERVERS [--out ROOT] [--max-files N]`` -- the four streaming
  stages over topic-row files or the source topics, each drained with ``availableNow`` (re-run
  to resume);
* ``live --topics PATH --seconds S [--out ROOT] [--every TRIGGER]`` -- the four stages at once, tended
  for S seconds (a stage that ends is started again), then drained;
* ``pending --unique PATH [--out ROOT]`` -- orders whose wait is over, from the deduplication stage's
  log (re-run to resume);
* ``query NAME --data DIR [--out PATH]`` -- one registered query, its first rows shown or all of
  them written as parquet.

Spark's web page stays off unless ``--web-page`` is given.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans import backfill
from .plans.flow import EventFlow
from .plans.queries import queries
from .session import apply_settings, cluster_settings, pin_utc, scratch_path
from .sources import topics
from .streaming import jobs, pending
from .streaming.live import LivePipeline


#: Rows that a query without ``--out`` shows.
SHOWN = 20


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="orderflow")
    ap.add_argument("--input-bytes", type=int, default=None,
                    help="input volume used to size shuffle partitions")
    ap.add_argument("--web-page", action="store_true", help="turn Spark's web page on")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("backfill")
    b.add_argument("--data", required=True)
    b.add_argument("--out")
    b.add_argument("--splits", type=int, help="tasks that derive and parse the log (for files with few row groups)")
    p = sub.add_parser("pipeline")
    where = p.add_mutually_exclusive_group(required=True)
    where.add_argument("--topics", help="folder of topic-row files")
    where.add_argument("--kafka", help="bootstrap servers (needs the connector on the classpath)")
    p.add_argument("--out")
    p.add_argument("--max-files", type=int, default=None)
    v = sub.add_parser("live", help="all stages at once, tended for a time, then drained")
    v.add_argument("--topics", required=True, help="folder of topic-row files")
    v.add_argument("--out")
    v.add_argument("--seconds", type=float, required=True)
    v.add_argument("--every", default="5 seconds", help="trigger of each stage")
    e = sub.add_parser("pending", help="orders whose wait is over, from a log of unique events")
    e.add_argument("--unique", required=True, help="folder of the deduplication stage's log")
    e.add_argument("--out")
    q = sub.add_parser("query")
    q.add_argument("name", choices=sorted(queries()))
    q.add_argument("--data", required=True)
    q.add_argument("--out")
    args = ap.parse_args(argv)

    spark = (SparkSession.builder.appName(f"orderflow-{args.cmd}")
             .config("spark.ui.enabled", str(args.web_page).lower()).getOrCreate())
    apply_settings(spark, cluster_settings(args.input_bytes))
    pin_utc(spark)
    if args.cmd == "backfill":
        tables = backfill.run_backfill(spark, EventFlow(spark, args.data, args.splits).topic_rows, args.out)
        print(tables.root)
    elif args.cmd == "pipeline":
        source = topics.kafka_topics(spark, args.kafka) if args.kafka else topics.file_topics(
            spark, args.topics, max_files_per_trigger=args.max_files, max_bytes_per_trigger=topics.BATCH_BYTES)
        paths = jobs.run_pipeline(spark, source, args.out, args.max_files)
        print(paths.root)
    elif args.cmd == "live":
        source = topics.file_topics(spark, args.topics, max_bytes_per_trigger=topics.BATCH_BYTES)
        running = LivePipeline(spark, source, args.out, {"processingTime": args.every}).start()
        try:
            running.run(args.seconds)
            running.drain()
        finally:
            running.stop()
        print(running.paths.root)
    elif args.cmd == "pending":
        root = args.out or scratch_path(spark, "pending")
        jobs.run_to_end(pending.run_pending(topics.key_value_log(spark, args.unique), f"{root}/expired", f"{root}/checkpoint"))
        print(root)
    else:
        df = queries()[args.name](spark, args.data)
        if args.out:
            df.write.mode("overwrite").parquet(args.out)
            print(args.out)
        else:
            rows = df.take(SHOWN + 1)
            spark.createDataFrame(rows[:SHOWN], df.schema).show(SHOWN, truncate=False)
            if len(rows) > SHOWN:
                print(f"these are the first {SHOWN} rows; --out PATH writes them all")
    return 0


if __name__ == "__main__":
    sys.exit(main())
