"""Command line: `spark-submit ... -m rollbook <job>` or `python -m rollbook <job>`."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession

from rollbook.fixed import INTERVAL, MAX_PER_TRIGGER, QUOTA, STORE_PACING, TOPIC
from rollbook.plans.consume import consume
from rollbook.plans.produce import drain_responses, produce
from rollbook.session import SessionOptions, build_session
from rollbook.sinks.connector import store_writer
from rollbook.sinks.messages import kafka_sink_options, publish_files, publish_kafka
from rollbook.sinks.tables import UserTable, merge_log
from rollbook.sinks.user_log import batch_writer, compact_log
from rollbook.sources.messages import file_caps, file_retirement, kafka_options, read_kafka, read_message_files, record_caps
from rollbook.sources.responses import read_responses
from rollbook.streaming.progress import progress_told


def _add_file_options(job: argparse.ArgumentParser) -> None:
    job.add_argument("--max-files-per-trigger", type=int, help="of a batch from files")
    job.add_argument("--max-bytes-per-trigger", type=int, help="of a batch from files")
    job.add_argument("--archive", help="folder that files move to once their batch is done")
    job.add_argument("--max-file-age", help="of files that are still taken, as in 7d")


def _refuse(parser: argparse.ArgumentParser, args: argparse.Namespace) -> None:
    """Flags that do not apply to the chosen source are errors, not ignored."""

    def given(*names: str) -> list[str]:
        return [f"--{n.replace('_', '-')}" for n in names if getattr(args, n, None) is not None]

    caps = given("max_files_per_trigger", "max_bytes_per_trigger", "max_records_per_trigger")
    if len(caps) > 1:
        parser.error(f"{' and '.join(caps)} exclude each other")
    of_files = caps + given("archive", "max_file_age")
    if args.job == "produce" and args.servers and given("max_records_per_file"):
        parser.error("--max-records-per-file does not apply to --servers")
    if args.job == "produce" and not args.checkpoint and of_files:
        parser.error(f"{of_files[0]} needs --checkpoint")
    if args.job == "consume":
        wrong = of_files if args.servers else given("max_per_trigger", "min_partitions")
        if wrong:
            parser.error(f"{wrong[0]} does not apply to {'--servers' if args.servers else '--messages'}")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="rollbook")
    parser.add_argument("--shuffle-partitions", type=int)
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("produce", help="landed responses to messages")
    job.add_argument("--responses", required=True)
    job.add_argument("--format", default="parquet", help="of the responses")
    job.add_argument("--staging", required=True)
    job.add_argument("--checkpoint", help="take only responses landed since the last run")
    _add_file_options(job)
    target = job.add_mutually_exclusive_group(required=True)
    target.add_argument("--servers", help="Kafka brokers")
    target.add_argument("--out", help="folder for message files, a stand-in for brokers")
    job.add_argument("--max-records-per-file", type=int, help="of message files")
    job.add_argument("--topic", default=TOPIC)
    job.add_argument("--quota", type=int, default=QUOTA, help="of a run; 0 publishes everything")
    job.add_argument("--keyed-ids", action="store_true", help="ids derived from the request")

    job = jobs.add_parser("consume", help="messages to the log")
    source = job.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka brokers")
    source.add_argument("--messages", help="folder of message files")
    job.add_argument("--topic", default=TOPIC)
    job.add_argument(
        "--max-per-trigger", type=int, help=f"messages per batch from brokers, {MAX_PER_TRIGGER} unless given; 0 lifts it"
    )
    job.add_argument("--min-partitions", type=int, help="of a batch from brokers")
    job.add_argument("--max-records-per-trigger", type=int, help="of a batch from files, none of which may hold more")
    _add_file_options(job)
    job.add_argument("--log", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--table-folder", required=True)
    job.add_argument("--buckets", type=int, default=UserTable.buckets, help="of a new table")
    job.add_argument("--interval", default=INTERVAL, help="empty: no pause between batches")
    job.add_argument("--merge-files", action="store_true", help="fewer files per batch")
    job.add_argument("--drain", action="store_true", help="take what is there and end")
    job.add_argument("--store", metavar="HOST", help="write the newest record of each id to the store too")

    job = jobs.add_parser("merge", help="log into the base of the table")
    job.add_argument("--log", required=True)
    job.add_argument("--table-folder", required=True)
    job.add_argument("--buckets", type=int, help="of the merged base; as before unless given")

    job = jobs.add_parser("compact", help="log to a smaller log, where there is no catalog")
    job.add_argument("--log", required=True)
    job.add_argument("--target", required=True)
    return parser


def _produce(spark: SparkSession, args: argparse.Namespace) -> None:
    def publish(messages: DataFrame) -> None:
        if args.servers:
            publish_kafka(messages, kafka_sink_options(args.servers))
        else:
            publish_files(messages, args.out, args.max_records_per_file)

    quota = args.quota or None
    caps = file_caps(args.max_files_per_trigger, args.max_bytes_per_trigger)
    caps |= file_retirement(args.archive, max_age=args.max_file_age)
    responses = read_responses(
        spark, args.responses, args.format, streaming=bool(args.checkpoint), caps=caps
    )
    settings = {"quota": quota, "topic": args.topic, "keyed": args.keyed_ids}
    if args.checkpoint:
        with progress_told(spark):
            report = drain_responses(responses, publish, args.staging, args.checkpoint, **settings)
    else:
        report = produce(responses, publish, args.staging, **settings)
    print(asdict(report))


def _consume(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.servers:
        limit = MAX_PER_TRIGGER if args.max_per_trigger is None else args.max_per_trigger
        options = kafka_options(args.servers, args.topic, limit or None, args.min_partitions)
        messages = read_kafka(spark, options)
    else:
        caps = file_caps(args.max_files_per_trigger, args.max_bytes_per_trigger)
        if args.max_records_per_trigger:
            caps = record_caps(spark, args.messages, args.max_records_per_trigger)
        caps |= file_retirement(args.archive, max_age=args.max_file_age)
        messages = read_message_files(spark, args.messages, args.topic, caps)
    write = batch_writer(args.log, args.checkpoint, args.merge_files)
    if args.store:
        write = store_writer(write)
    table = UserTable(args.table_folder, args.log, buckets=args.buckets)
    with progress_told(spark):
        query = consume(messages, write, args.checkpoint, table, args.interval or None, args.drain)
        query.awaitTermination()


def main(argv: Sequence[str] | None = None) -> None:
    """Run one job. Errors are raised, which ends the process with a non-zero code."""
    logging.basicConfig(level=logging.WARNING)
    logging.getLogger("rollbook").setLevel(logging.INFO)
    parser = _parser()
    args = parser.parse_args(argv)
    _refuse(parser, args)
    extra = {}
    if getattr(args, "store", None):
        extra = {"spark.cassandra.connection.host": args.store, **STORE_PACING}
    spark = build_session(
        SessionOptions(shuffle_partitions=args.shuffle_partitions, extra=extra)
    )
    if args.job == "produce":
        _produce(spark, args)
    elif args.job == "consume":
        _consume(spark, args)
    elif args.job == "merge":
        merge_log(spark, UserTable(args.table_folder, args.log), args.buckets)
    else:
        compact_log(spark, args.log, args.target)


if __name__ == "__main__":
    main()
