"""The streaming half: messages in, keyed log out."""

from __future__ import annotations

import contextlib
import json
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rollbook.fixed import INTERVAL
from rollbook.operators.screening import screen_messages

BatchWriter = Callable[[DataFrame, int], None]

_FILE_MANAGER = "spark.sql.streaming.checkpointFileManagerClass"
_BY_FILE_SYSTEM = "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"
_SOURCE_LOG_KEPT = "spark.sql.streaming.fileSource.log.cleanupDelay"


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the streaming query that owns a checkpoint, the same at every start.

    A new checkpoint is a new query, though it counts its batches from 0 as well.
    """
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def start_ingest(
    messages: DataFrame,
    write_batch: BatchWriter,
    checkpoint: str,
    interval: str | None = INTERVAL,
    drain: bool = False,
) -> StreamingQuery:
    """Start ingesting `messages` and return the running query.

    `drain` takes what is there, within the source's rate limit, and ends. Otherwise
    the job runs until stopped, every `interval`, or without a pause when that is None.
    Progress is kept in `checkpoint`; starting again with the same one resumes there.
    Each batch is scan, decode and write in one stage, without a shuffle. Its progress
    carries the observed counts of `messages` and of `rejects` among them.
    """
    counts = [F.count(F.lit(1)).alias("messages"), F.count("reason").alias("rejects")]
    writer = (
        screen_messages(messages)
        .observe("ingest", *counts)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write_batch)
    )
    if drain:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


@contextlib.contextmanager
def _many_batches(spark: SparkSession, checkpoints: Sequence[str]) -> Iterator[None]:
    """Settings of the streams that run within, which take thousands of batches; those that the session has stay.

    With every batch a source lists the files of its log, of which Spark keeps for ten minutes those that it has
    compacted; here they go at once, but for the last hundred batches. And every batch writes three files to the
    checkpoint and renames them through Hadoop's `FileContext`. On a local disk that starts eight processes for a file,
    to ask whether it is a link, and is no more atomic than the rename of the `FileSystem`, which starts none.
    """
    usual = urlsplit(spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")).scheme
    settings = {_SOURCE_LOG_KEPT: "1ms"}
    if all((urlsplit(path).scheme or usual) == "file" for path in checkpoints):
        settings[_FILE_MANAGER] = _BY_FILE_SYSTEM
    # `getAll`, since a setting that nobody has made still has Spark's own value.
    settings = {name: value for name, value in settings.items() if name not in spark.conf.getAll}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name in settings:
            spark.conf.unset(name)


def drain_messages(
    messages: DataFrame, write_batch: BatchWriter, checkpoint: str
) -> StreamingQuery:
    """Ingest everything available and return the ended query, with the progress of its batches."""
    return drain_together([(messages, write_batch, checkpoint)])[0]


def drain_together(streams: Sequence[tuple[DataFrame, BatchWriter, str]]) -> list[StreamingQuery]:
    """Ingest everything available of several streams side by side, each with its writer and its checkpoint.

    The batches of one stream follow each other, and small ones leave a cluster idle. If a stream fails, the others
    are stopped, each between two batches or in one that is written again, and the error is raised.
    """
    queries: list[StreamingQuery] = []
    if not streams:
        return queries
    # Until the end, since a stream makes its source, which has a log of its own, some time after its start.
    with _many_batches(streams[0][0].sparkSession, [checkpoint for _, _, checkpoint in streams]):
        try:
            for messages, write_batch, checkpoint in streams:
                queries.append(start_ingest(messages, write_batch, checkpoint, drain=True))
            for query in queries:
                query.awaitTermination()
        finally:
            for query in queries:
                if query.isActive:
                    query.stop()
    return queries
