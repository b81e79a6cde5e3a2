"""The message log as a stream or a batch."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.fixed import MAX_PER_TRIGGER, TOPIC
from rollbook.schema import MESSAGE_SCHEMA


def kafka_options(
    servers: str,
    topic: str = TOPIC,
    max_per_trigger: int | None = MAX_PER_TRIGGER,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of Spark's Kafka source: one topic, from the beginning when there is no checkpoint.

    `min_partitions` above the topic's partition count splits large offset ranges,
    so that one hot topic partition is not read by a single task.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def file_caps(max_files: int | None = None, max_bytes: int | None = None) -> dict[str, str]:
    """Options of a file stream that bound a batch by number of files, or by their bytes."""
    if max_files and max_bytes:
        raise ValueError("a file stream is bounded by files or by bytes, not by both")
    caps = {"maxFilesPerTrigger": max_files, "maxBytesPerTrigger": max_bytes}
    return {name: str(value) for name, value in caps.items() if value}


def record_caps(spark: SparkSession, path: str, max_records: int, max_per_file: int | None = None) -> dict[str, str]:
    """Options of a stream of Parquet files that bound a batch by the number of its records, of all topics.

    Spark admits whole files, so files must not be larger than the bound: land them with `max_per_file`
    (see `publish_files`), which then also holds for those that come later, or leave it out to take the
    largest file there is now, by the counts in the files' footers. A larger one is refused.
    """
    place = F.col("_metadata.file_path")
    try:
        files = spark.read.parquet(path).groupBy(place.alias("file")).count()
        largest = files.agg(F.max("count")).first()[0] or 0
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        largest = 0  # nothing has landed yet
    largest = max(largest, max_per_file or 1)
    if largest > max_records:
        raise ValueError(f"a file of {largest} records cannot be admitted to batches of {max_records}; land smaller files")
    return file_caps(max_files=max_records // largest if max_per_file or largest > 1 else 1)


def file_retirement(archive: str | None = None, delete: bool = False, max_age: str | None = None) -> dict[str, str]:
    """Options of a long-lived file stream: what becomes of files once their batch is done, and of old ones.

    Without them every listing and the list of files in the checkpoint only grow. Files go to `archive`, a folder
    outside the source, or are deleted. Files older than `max_age` (as in "7d"), counted from the newest, are not
    taken any more and no longer remembered; Spark's own default is seven days.
    """
    if archive and delete:
        raise ValueError("files that were read are archived or deleted, not both")
    options = {"cleanSource": "archive", "sourceArchiveDir": archive} if archive else {}
    if delete:
        options = {"cleanSource": "delete"}
    return options | ({"maxFileAge": max_age} if max_age else {})


def read_kafka(
    spark: SparkSession, options: Mapping[str, str], streaming: bool = True
) -> DataFrame:
    """Messages of the subscribed topic. Needs the Kafka connector on the classpath."""
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**options).load()


def read_message_files(
    spark: SparkSession,
    path: str,
    topic: str = TOPIC,
    caps: Mapping[str, str] | None = None,
    streaming: bool = True,
) -> DataFrame:
    """Messages of one topic from Parquet files in the Kafka envelope's shape.

    `caps` are options of the file stream: `file_caps`, `record_caps`, `file_retirement`.

    The topic test is on an envelope column, so it reaches the file scan and runs
    before any message is decoded.
    """
    reader = spark.readStream.options(**(caps or {})) if streaming else spark.read
    return reader.schema(MESSAGE_SCHEMA).parquet(path).filter(F.col("topic") == topic)
