"""The ingest log: the append side of the keyed table, on plain Parquet.

Every micro-batch owns the directory `run=<run>/batch_id=<n>`. Writing the batch
again after a failure replaces that directory, so a replay leaves no second copy.
The run is the id of the streaming query, which lives in its checkpoint: a new
checkpoint counts batches from 0 again, in directories of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rollbook.operators.latest import latest_versions, rejected_messages
from rollbook.schema import LOG_SCHEMA
from rollbook.streaming.ingest import query_id

#: Options of Parquet files that are looked up by id. Ids are random, so that the least and the greatest of a row group
#: skip nothing, and hardly repeat, so that a dictionary of them is only as large: a Bloom filter of a fitting size skips
#: the row groups without the id.
LOOKUP_OPTIONS = {
    "parquet.enable.dictionary#id": "false",
    "parquet.bloom.filter.enabled#id": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}

_FILE_FIELDS = [field for field in LOG_SCHEMA.fields if field.name not in ("run", "batch_id")]


def batch_writer(
    path: str, checkpoint: str, merge_files: bool = False
) -> Callable[[DataFrame, int], None]:
    """The `foreachBatch` function that writes screened messages to the log at `path`.

    `checkpoint` is that of the stream it writes for.

    Every task writes a file, one per topic partition and batch. `merge_files` adds a
    shuffle that lets adaptive execution settle on fewer and evener ones, which pays
    when batches are small and topic partitions many.
    """
    run: str | None = None

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal run
        if run is None or batch_id == 0:  # another checkpoint begins with 0
            run = query_id(batch.sparkSession, checkpoint)
        if merge_files:
            batch = batch.hint("rebalance")
        batch.write.mode("overwrite").options(**LOOKUP_OPTIONS).parquet(f"{path}/run={run}/batch_id={batch_id}")

    return write


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The whole log. Filters on `run` and `batch_id` select directories."""
    return spark.read.schema(LOG_SCHEMA).option("basePath", path).parquet(path)


def ensure_log(spark: SparkSession, path: str) -> None:
    """Make the log readable before its first batch: one empty file with its columns."""
    empty = spark.createDataFrame([], T.StructType(_FILE_FIELDS)).coalesce(1)
    empty.write.mode("ignore").parquet(f"{path}/run=none/batch_id=0")


def compact_log(spark: SparkSession, path: str, target: str) -> None:
    """Write the log at `path` again under `target`: one stored row per id, each reject once.

    Positions are kept, so rows that a restarted stream adds under `target` compete
    with the compacted ones as before, and a batch that is both compacted and
    replayed there changes nothing. Files come out ordered by id, which lets a
    lookup by id skip most row groups.
    """
    log = read_log(spark, path)
    rows = latest_versions(log).unionByName(rejected_messages(log), allowMissingColumns=True)
    columns = [field.name for field in _FILE_FIELDS]
    rows.select(*columns).write.mode("overwrite").options(**LOOKUP_OPTIONS).parquet(f"{target}/run=compacted/batch_id=0")
