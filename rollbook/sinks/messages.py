"""Publishing messages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kafka_sink_options(servers: str) -> dict[str, str]:
    """Options of Spark's Kafka sink: a write counts once all in-sync replicas have it."""
    return {"kafka.bootstrap.servers": servers, "kafka.acks": "all"}


def publish_kafka(messages: DataFrame, options: Mapping[str, str]) -> None:
    """Send `topic` and `value` rows. Returns after every task has flushed its sends."""
    messages.write.format("kafka").options(**options).save()


def publish_files(messages: DataFrame, path: str, max_per_file: int | None = None) -> None:
    """A stand-in for a broker, for trials and checks: `topic` and `value` rows as Parquet in the envelope's shape.

    It appends, so a run that is finished after a failure adds its messages again, as
    a broker would get them again; their ids are the same.
    Each task is one partition of the log and numbers its own messages, so no
    task waits for another and nothing is sorted. `max_per_file` bounds the messages
    of a file, so that a stream of them can be bounded by messages.
    """
    task_row = F.monotonically_increasing_id()
    messages.select(
        F.lit(None).cast("binary").alias("key"),
        "value",
        "topic",
        F.spark_partition_id().alias("partition"),
        task_row.bitwiseAND(F.lit((1 << 33) - 1)).alias("offset"),
        F.current_timestamp().alias("timestamp"),
        F.lit(0).alias("timestampType"),
    ).write.mode("append").options(**file_size(max_per_file)).parquet(path)


def file_size(max_per_file: int | None) -> dict[str, str]:
    """Options of a writer of files with at most so many rows each."""
    return {"maxRecordsPerFile": str(max_per_file)} if max_per_file else {}
