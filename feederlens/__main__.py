"""Command line: ``spark-submit`` or ``python -m feederlens <job> ...``."""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from feederlens.plans import jobs
from feederlens.sources import files, jdbc, kafka
from feederlens.sources.daytables import DayTables
from feederlens.streaming.feeding import FolderFeed, to_topic
from feederlens.streaming.job import LoadJob
from feederlens.streaming.stopping import run_until_marker


def _database(url: str) -> jdbc.Database:
    """Connection data come from the environment, never from the command line."""
    names = {"user": "FEEDERLENS_DB_USER", "password": "FEEDERLENS_DB_PASSWORD",
             "driver": "FEEDERLENS_DB_DRIVER"}
    return jdbc.Database(url, {k: os.environ[v] for k, v in names.items() if v in os.environ})


def _arguments(given: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="feederlens")
    sub = parser.add_subparsers(dest="job", required=True)
    stream = sub.add_parser("stream", help="load rates of a Kafka topic or a watched folder")
    stream.add_argument("root")
    _add_dimension(stream)
    stream.add_argument("--refresh-weekday", type=int, choices=range(7), help="reload the dimension on this day only, 0 is Sunday")
    stream.add_argument("--brokers")
    stream.add_argument("--topics")
    stream.add_argument("--folder")
    stream.add_argument("--interval", default="5 second")
    stream.add_argument("--max-records", type=int)
    stream.add_argument("--stop-marker", required=True)
    batch = sub.add_parser("batch", help="load rates of text files")
    batch.add_argument("lines")
    batch.add_argument("root")
    _add_dimension(batch)
    export = sub.add_parser("export", help="database table to CSV")
    export.add_argument("url")
    export.add_argument("table")
    export.add_argument("output")
    export.add_argument("--column", required=True, help="numeric column, or text key with --bounds")
    export.add_argument("--lower", type=int, default=1000)
    export.add_argument("--upper", type=int, default=10000)
    export.add_argument("--bounds", nargs="+", help="read in ranges of a text key between these values")
    export.add_argument("--columns", nargs="+", default=["*"], help="with --bounds: the columns to write")
    load = sub.add_parser("load", help="transformer dimension from CSV to a database table")
    load.add_argument("csv")
    load.add_argument("url")
    load.add_argument("table")
    compact = sub.add_parser("compact", help="lines with a text, sorted by time")
    compact.add_argument("lines")
    compact.add_argument("wanted")
    compact.add_argument("output")
    compact.add_argument("--files", type=int)
    merge = sub.add_parser("merge-days", help="one folder per closed day and table")
    merge.add_argument("root", help="folder of the day tables")
    merge.add_argument("--open-days", type=int, default=2, help="newest days that stay as they are")
    merge.add_argument("--clean-hours", type=float, default=24, help="age at which replaced folders are deleted")
    feeder = sub.add_parser("feed", help="files to a Kafka topic")
    feeder.add_argument("folder")
    feeder.add_argument("brokers")
    feeder.add_argument("topic")
    watch = sub.add_parser("watch", help="files of a folder to a Kafka topic, as they appear or change")
    watch.add_argument("folder")
    watch.add_argument("root", help="folder for the log of sent files and the checkpoint")
    watch.add_argument("brokers")
    watch.add_argument("topic")
    watch.add_argument("--stop-marker", required=True)
    watch.add_argument("--poll-seconds", type=float, default=10)
    peek = sub.add_parser("peek", help="some records of a Kafka topic")
    peek.add_argument("brokers")
    peek.add_argument("topic")
    peek.add_argument("offset", type=int)
    peek.add_argument("--partition", type=int, default=0)
    return parser.parse_args(given)


def _add_dimension(parser: argparse.ArgumentParser) -> None:
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--dimension", help="CSV of the transformer dimension")
    source.add_argument("--dimension-url", help="database that has it; see --dimension-table")
    parser.add_argument("--dimension-table", default="transformer")


def _dimension(args: argparse.Namespace) -> Callable[[SparkSession], DataFrame]:
    if args.dimension:
        return lambda spark: files.read_dimension_csv(spark, args.dimension)
    return lambda spark: jobs.dimension_from_database(spark, _database(args.dimension_url), args.dimension_table)


def main(given: Sequence[str] | None = None) -> None:
    args = _arguments(given)
    spark = SparkSession.builder.appName(f"feederlens-{args.job}").getOrCreate()
    if args.job == "stream":
        if args.folder:
            lines = files.watch_lines(spark, args.folder, args.max_records)
        else:
            lines = kafka.read_stream(
                spark, args.brokers, args.topics, max_records=args.max_records
            )
        job = LoadJob(args.root, _dimension(args), refresh_weekday=args.refresh_weekday)
        run_until_marker(spark, job.start(lines, args.interval), args.stop_marker)
    elif args.job == "batch":
        jobs.analyse(files.read_lines(spark, args.lines), _dimension(args)(spark), args.root)
    elif args.job == "export" and args.bounds:
        jobs.export_by_ranges(
            spark, _database(args.url), args.columns, args.table, args.column, args.bounds, args.output
        )
    elif args.job == "export":
        jobs.export_by_bounds(
            spark, _database(args.url), args.table, args.column, args.lower, args.upper, args.output
        )
    elif args.job == "load":
        jobs.load_dimension(spark, args.csv, _database(args.url), args.table)
    elif args.job == "compact":
        jobs.compact_text(spark, args.lines, args.wanted, args.output, args.files)
    elif args.job == "merge-days":
        tables = DayTables(args.root)
        tables.merge_days(spark, tables.closed_days(spark, args.open_days))
        tables.clean(spark, args.clean_hours)
    elif args.job == "watch":
        feed = FolderFeed(args.folder, args.root, to_topic(args.brokers, args.topic))
        feed.run(spark, args.stop_marker, args.poll_seconds)
    elif args.job == "feed":
        jobs.feed(spark, args.folder, args.brokers, args.topic)
    elif args.job == "peek":
        kafka.peek_topic(spark, args.brokers, args.topic, args.partition, args.offset).show(
            20, truncate=False
        )


if __name__ == "__main__":
    main()
