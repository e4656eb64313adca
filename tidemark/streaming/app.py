"""The bronze job of one feed, the model streams of both, the checks of each minute, or the pages, for spark-submit.

    spark-submit tidemark/streaming/app.py --feed market_prices --root s3a://lake \\
        --format kafka --location broker:9092 --topic cdc.public.market_prices
    spark-submit tidemark/streaming/app.py --models --root s3a://lake
    spark-submit tidemark/streaming/app.py --checks --root s3a://lake
    spark-submit tidemark/streaming/app.py --pages --root s3a://lake --location s3a://pages
"""

from __future__ import annotations

import argparse
import os
import sys
import time
from contextlib import contextmanager

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from tidemark.plans.warehouse import Warehouse  # noqa: E402
from tidemark.schemas import FEEDS  # noqa: E402
from tidemark.session import build_session  # noqa: E402
from tidemark.sources.changes import cdc_stream  # noqa: E402
from tidemark.streaming.pipeline import start_bronze  # noqa: E402
from tidemark.streaming.progress import ProgressLog  # noqa: E402

LISTENER_WAIT_MS = 60_000


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    what = parser.add_mutually_exclusive_group(required=True)
    what.add_argument("--feed", choices=sorted(FEEDS), help="run this feed into bronze")
    what.add_argument("--models", action="store_true", help="keep silver and gold up to date from bronze")
    what.add_argument("--pages", action="store_true", help="bring page files of the remote API into the source tables")
    what.add_argument("--checks", action="store_true", help="record the reports and settle the alerts each minute")
    parser.add_argument("--compact-minutes", type=int, default=60, help="time between compactions of the models, or of the tables by the checks")
    parser.add_argument("--compact-parts", type=int, default=4, help="parts of a size that a model table gathers before they are merged")
    parser.add_argument("--minutes", type=int, help="stop the checks after so many")
    parser.add_argument("--built", action="store_true", help="check the facts as last built, not those of the model streams")
    parser.add_argument("--root", required=True, help="warehouse folder")
    parser.add_argument("--format", choices=["kafka", "json", "parquet"], default="kafka")
    parser.add_argument("--location", help="brokers, or the folder of event files")
    parser.add_argument("--topic")
    parser.add_argument("--reader-schema", help="file with the Avro schema of the message values")
    parser.add_argument("--writer-schema", action="append", default=[], metavar="ID=FILE", help="a registered schema of the values, by its id")
    parser.add_argument("--max-per-batch", help="offsets or files per micro-batch")
    parser.add_argument("--out-topic", help="also publish bronze rows to this topic")
    parser.add_argument("--dead-letter-topic")
    parser.add_argument("--available-now", action="store_true", help="stop when caught up")
    args = parser.parse_args(argv)
    if (args.feed or args.pages) and not args.location:
        parser.error("--feed and --pages need --location")
    return args


def run_models(args: argparse.Namespace) -> None:
    """Follow bronze until stopped, or until caught up, and compact now and then."""
    lake = Warehouse(build_session("models"), args.root, incremental=True)
    with logged(lake):
        follow_models(lake, args)


@contextmanager
def logged(lake: Warehouse):
    """Keep the progress reports of the queries that run meanwhile."""
    spark = lake.spark
    log = ProgressLog(spark, f"{lake.monitoring}/progress")
    spark.streams.addListener(log)
    try:
        yield
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(LISTENER_WAIT_MS)
    finally:
        spark.streams.removeListener(log)


def follow_models(lake: Warehouse, args: argparse.Namespace) -> None:
    running = lake.start_models(args.available_now, int(args.max_per_batch) if args.max_per_batch else None)
    while any(query.isActive for query in running):
        if running[0].awaitTermination(args.compact_minutes * 60):
            for query in running:
                query.awaitTermination()
        lake.compact_models(fanout=args.compact_parts)


def run_checks(args: argparse.Namespace) -> None:
    """Check at the beginning of each minute, and tidy the tables now and then.

    A minute that takes longer than a minute is followed by the present one; what the
    reports say of the minutes between is settled with it.
    """
    lake = Warehouse(build_session("checks"), args.root, incremental=not args.built)
    done = 0
    while args.minutes is None or done < args.minutes:
        lake.record_checks()
        done += 1
        if done % args.compact_minutes == 0:
            lake.tidy()
        if done != args.minutes:
            time.sleep(60 - time.time() % 60)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    if args.models:
        return run_models(args)
    if args.checks:
        return run_checks(args)
    if args.pages:
        lake = Warehouse(build_session("pages"), args.root)
        with logged(lake):
            lake.start_pages(args.location, args.available_now, int(args.max_per_batch) if args.max_per_batch else None).awaitTermination()
        return None
    spark = build_session(f"bronze-{args.feed}")
    feed = FEEDS[args.feed]
    limit = "maxOffsetsPerTrigger" if args.format == "kafka" else "maxFilesPerTrigger"
    options = {limit: args.max_per_batch} if args.max_per_batch else {}
    schema = None
    if args.reader_schema:
        with open(args.reader_schema, encoding="utf-8") as handle:
            schema = handle.read()
    written = {}
    for number, path in (item.split("=", 1) for item in args.writer_schema):
        with open(path, encoding="utf-8") as handle:
            written[int(number)] = handle.read()
    changes = cdc_stream(spark, feed, args.location, args.format, args.topic, schema, written, **options)

    def broker(topic: str | None) -> dict[str, str] | None:
        return {"kafka.bootstrap.servers": args.location, "topic": topic} if topic else None

    warehouse = Warehouse(spark, args.root)
    targets = warehouse.targets(feed, broker(args.out_topic), broker(args.dead_letter_topic))
    checkpoint = f"{warehouse.root}/checkpoints/{feed.name}"
    with logged(warehouse):
        start_bronze(changes, feed, targets, checkpoint, args.available_now).awaitTermination()


if __name__ == "__main__":
    main()
