"""Message encoding and decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.fixed import TOPIC, USER_COLUMNS
from rollbook.schema import USER_SCHEMA

CORRUPT = "_corrupt_record"


def record_json(*columns: str) -> Column:
    """The record as JSON text; NULL fields are written as null, not left out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def encode_messages(users: DataFrame, topic: str = TOPIC) -> DataFrame:
    """Records as keyless messages: `topic` and UTF-8 JSON bytes in `value`."""
    return users.select(
        F.lit(topic).alias("topic"), record_json(*USER_COLUMNS).cast("binary").alias("value")
    )


def message_text(messages: DataFrame) -> DataFrame:
    """Message bytes as text."""
    return messages.select(F.col("value").cast("string").alias("value"))


def decode_messages(messages: DataFrame, schema: T.StructType = USER_SCHEMA) -> DataFrame:
    """Messages as columns. A message that cannot be parsed stays, as a row of NULLs."""
    text = F.col("value").cast("string")
    return messages.select(F.from_json(text, schema).alias("record")).select("record.*")
