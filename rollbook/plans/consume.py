"""The consuming half: message source to keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from rollbook.fixed import INTERVAL
from rollbook.sinks.tables import UserTable, ensure_table
from rollbook.streaming.ingest import BatchWriter, start_ingest


def consume(
    messages: DataFrame,
    write_batch: BatchWriter,
    checkpoint: str,
    table: UserTable,
    interval: str | None = INTERVAL,
    drain: bool = False,
) -> StreamingQuery:
    """Create the table if needed, then start the stream. A failure of either is raised."""
    ensure_table(messages.sparkSession, table)
    return start_ingest(messages, write_batch, checkpoint, interval, drain)
