"""Command line for ``spark-submit``: one command per job.

    spark-submit --py-files orderloom.zip orderloom/jobs.py full-load \\
        --root hdfs:///shop --database shop --jdbc-url jdbc:postgresql://db/shop \\
        --options-file login.json --source-schema sales --split orders=order_id:64

Session settings (master, Hive support, jars, shuffle partitions,
``spark.checkpoint.dir``) are given to ``spark-submit``. The options file holds
JDBC or Kafka options as one JSON object, so that no password is an argument.
"""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from orderloom.plans.runs import (
    Lakehouse,
    build_gold,
    build_silver,
    load_bronze,
    publish_stream,
    run_full_load,
    run_incremental,
    run_incremental_segments,
)
from orderloom.sources.events import file_events, kafka_events
from orderloom.sources.relational import RangeSplit, TableReader, jdbc_reader
from orderloom.streaming.ingest import start_ingest
from orderloom.streaming.progress import batches
from orderloom.streaming.publish import latest_orders
from orderloom.streaming.refine import start_refine
from orderloom.streaming.segments import refine_new

log = logging.getLogger(__name__)

BATCH_JOBS = ("bronze", "silver", "gold", "full-load")
STREAM_JOBS = ("ingest", "refine", "publish", "incremental")


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="orderloom")
    parser.add_argument("job", choices=BATCH_JOBS + STREAM_JOBS)
    parser.add_argument("--root", required=True, help="folder of all layers")
    parser.add_argument("--database", required=True)
    parser.add_argument("--key-type", choices=("int", "bigint"), default="int")
    parser.add_argument("--options-file", help="JSON file with JDBC or Kafka options")
    parser.add_argument("--jdbc-url")
    parser.add_argument("--source-schema", default="")
    parser.add_argument(
        "--split",
        action="append",
        default=[],
        metavar="TABLE=COLUMN:PARTITIONS",
        help="read a table by ranges of a column",
    )
    parser.add_argument("--kafka-servers")
    parser.add_argument("--topic", default="orders")
    parser.add_argument("--events-folder", help="read events from parquet files instead of Kafka")
    parser.add_argument(
        "--interval", help="keep ingest or refine running, e.g. '5 seconds'; else drain and stop"
    )
    parser.add_argument(
        "--stop-after-idle", type=float, metavar="SECONDS", help="end an interval run without new data"
    )
    parser.add_argument("--max-files", help="files per micro-batch (or segment) of the refinement")
    parser.add_argument(
        "--buckets", type=int, help="deal lines and orders into buckets of their order id before gold"
    )
    parser.add_argument(
        "--segments",
        action="store_true",
        help="refine or incremental: without state, into segments that are folded (drains and stops)",
    )
    args = parser.parse_args(argv)
    if args.segments and (args.job not in ("refine", "incremental") or args.interval):
        parser.error("--segments is for refine and incremental, without --interval")
    if args.job in ("bronze", "full-load") and not args.jdbc_url:
        parser.error(f"{args.job} needs --jdbc-url")
    if args.job in ("ingest", "incremental") and not (args.kafka_servers or args.events_folder):
        parser.error(f"{args.job} needs --kafka-servers or --events-folder")
    return args


def split_of(text: str) -> tuple[str, RangeSplit]:
    table, _, rule = text.partition("=")
    column, _, partitions = rule.partition(":")
    return table, RangeSplit(column, int(partitions))


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    lake = Lakehouse(args.root, args.database, args.key_type)
    limits = {"maxFilesPerTrigger": args.max_files} if args.max_files else None
    if args.job == "bronze":
        log.info("rows: %s", load_bronze(_source(spark, args), lake))
    elif args.job == "silver":
        log.info("rows: %s", build_silver(spark, lake))
    elif args.job == "gold":
        log.info("rows: %s", build_gold(spark, lake, buckets=args.buckets))
    elif args.job == "full-load":
        run_full_load(spark, _source(spark, args), lake, buckets=args.buckets)
    elif args.job == "ingest":
        query = start_ingest(
            _events(spark, args),
            lake.stream("bronze"),
            lake.checkpoint("ingest"),
            args.interval,
            lake.key_type,
        )
        _follow(query, args)
    elif args.segments:
        lot = {"max_files": int(args.max_files)} if args.max_files else {}
        if args.job == "refine":
            log.info("new: %d", refine_new(spark, lake.stream("bronze"), lake.segments, **lot))
        else:
            run_incremental_segments(spark, _events(spark, args), lake, **lot)
    elif args.job == "refine":
        query = start_refine(
            spark,
            lake.stream("bronze"),
            lake.stream("silver"),
            lake.checkpoint("refine"),
            args.interval,
            lake.key_type,
            limits,
        )
        _follow(query, args)
    elif args.job == "publish":
        publish_stream(spark, lake)
    else:
        run_incremental(spark, _events(spark, args), lake, limits)
    if args.segments:
        latest_orders(spark, lake.segments.name).show(truncate=False)
    elif args.job in ("publish", "incremental"):
        latest_orders(spark, lake.stream_table).show(truncate=False)
    elif args.job in ("silver", "gold", "full-load"):
        spark.sql(f"SHOW TABLES IN {lake.database}").show(truncate=False)


def _follow(query: StreamingQuery, args: argparse.Namespace) -> None:
    for batch in batches(query, args.stop_after_idle):
        log.info("%s: %s", args.job, batch)


def _options(args: argparse.Namespace) -> dict[str, str]:
    if not args.options_file:
        return {}
    with open(args.options_file, encoding="utf-8") as file:
        return json.load(file)


def _source(spark: SparkSession, args: argparse.Namespace) -> TableReader:
    splits = dict(split_of(text) for text in args.split)
    return jdbc_reader(spark, args.jdbc_url, _options(args), args.source_schema, splits)


def _events(spark: SparkSession, args: argparse.Namespace):
    if args.events_folder:
        return file_events(spark, args.events_folder, _options(args))
    return kafka_events(spark, args.kafka_servers, args.topic, _options(args))


def main() -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    args = arguments()
    spark = SparkSession.builder.appName(f"orderloom-{args.job}").getOrCreate()
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
