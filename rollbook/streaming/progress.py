"""What a running stream has done, batch by batch."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable
from contextlib import contextmanager
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

Progress = dict[str, Any]
_LOG = logging.getLogger("rollbook.progress")


def to_log(progress: Progress) -> None:
    _LOG.info(json.dumps(progress))


class ProgressListener(StreamingQueryListener):
    """Hands on one dictionary per batch, while the stream runs: its number, the rows it read, how long it took, and
    the counts that the stream observes; and one for the end of a query, with the error if there was one.

    Spark calls it from a thread of its own, in the order of the batches, shortly after each.
    """

    def __init__(self, tell: Callable[[Progress], None] = to_log):
        self.tell = tell

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        batch = event.progress
        observed = {f"{name}.{k}": v for name, row in batch.observedMetrics.items() for k, v in row.asDict().items()}
        if batch.numInputRows or any(observed.values()):
            self.tell(
                {"query": str(batch.id), "batch_id": batch.batchId, "rows": batch.numInputRows, "ms": batch.batchDuration}
                | observed
            )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.tell({"query": str(event.id), "ended": True, "error": event.exception})


@contextmanager
def progress_told(spark: SparkSession, tell: Callable[[Progress], None] = to_log):
    """Within it, the progress of every stream of the session is told."""
    listener = ProgressListener(tell)
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)
