"""Writing to a key-value store through its Spark connector."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.fixed import DATABASE, STORE_FORMAT, TABLE, USER_COLUMNS
from rollbook.operators.latest import latest_versions


def store_options(keyspace: str = DATABASE, table: str = TABLE) -> dict[str, str]:
    return {"keyspace": keyspace, "table": table}


def store_writer(
    log_writer: Callable[[DataFrame, int], None],
    options: Mapping[str, str] | None = None,
    format: str = STORE_FORMAT,
    write_time: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function: the whole batch to `log_writer`, then one row per id to the store.

    The store keeps one row per key, and the last to arrive; the batch is therefore
    reduced to the newest message of each id. `write_time` names a column to add with
    the message's time in microseconds, and the connector option of that name is set
    to it, for a store that resolves conflicts by time. Batches follow one another, so
    without it a replayed older batch is put right by those after it.
    The batch is cached because it feeds two writes.
    """
    target = dict(options or store_options())

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            log_writer(batch, batch_id)
            users, columns = latest_versions(batch), list(USER_COLUMNS)
            if write_time:
                users = users.withColumn(write_time, F.unix_micros("timestamp"))
                columns.append(write_time)
                target[write_time] = write_time
            users.select(*columns).write.format(format).options(**target).mode("append").save()
        finally:
            batch.unpersist()

    return write
