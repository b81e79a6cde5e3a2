"""The one definition of every record shape used by the package."""

from __future__ import annotations

from pyspark.sql import types as T

from rollbook.fixed import USER_COLUMNS

# Every column is text. `from_json` ignores declared nullability, so none is declared.
USER_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in USER_COLUMNS])

# One row per fetch attempt: what the API answered to `request_id`.
RESPONSE_SCHEMA = T.StructType(
    [
        T.StructField("request_id", T.LongType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("body", T.StringType()),
    ]
)

# The envelope Spark's Kafka source produces; file stand-ins use the same shape.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

# Position of a message: among several writes of one id the highest position wins.
POSITION = ("timestamp", "partition", "offset")

# The ingest log: the record, its position, and for a message that cannot be stored the
# reason and the raw bytes. `run` and `batch_id` are directory partitions. `reason` is not:
# that would double the number of files, and null counts already let a reader of rejects
# skip the row groups without one.
LOG_SCHEMA = T.StructType(
    [
        *USER_SCHEMA.fields,
        *[MESSAGE_SCHEMA[name] for name in POSITION],
        T.StructField("reason", T.StringType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("run", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
