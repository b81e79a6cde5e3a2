"""Separating messages that can be stored under a key from those that cannot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.fixed import USER_COLUMNS
from rollbook.functions.identifiers import canonical_id, is_uuid
from rollbook.operators.once import with_once
from rollbook.operators.wire import CORRUPT
from rollbook.schema import POSITION, USER_SCHEMA

_SCREEN_SCHEMA = T.StructType([*USER_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])


def _reason(data: Column) -> Column:
    return (
        F.when(data.isNull(), F.lit("empty message"))
        .when(data[CORRUPT].isNotNull(), F.lit("malformed JSON"))
        .when(data["id"].isNull(), F.lit("missing id"))
        .when(~is_uuid(data["id"]), F.lit("id is not a UUID"))
    )


def screen_messages(messages: DataFrame) -> DataFrame:
    """Decoded messages with their position; those without a usable key get a reason.

    Such a message would fail the write of its whole batch, and the restarted stream
    would meet it again; here it is marked, and carried along with its bytes. Both
    kinds stay in one frame so that a batch is decoded and written once.
    """
    data = F.from_json(F.col("value").cast("string"), _SCREEN_SCHEMA)
    decoded = with_once(messages.select(*POSITION, "value"), "data", data)
    judged = decoded.withColumn("reason", _reason(F.col("data")))
    return judged.select(
        canonical_id(F.col("data.id")).alias("id"),
        *[F.col(f"data.{name}") for name in USER_COLUMNS[1:]],
        *POSITION,
        "reason",
        F.when(F.col("reason").isNotNull(), F.col("value")).alias("value"),
    )


def storable(screened: DataFrame) -> DataFrame:
    return screened.filter(F.col("reason").isNull())


def rejected(screened: DataFrame) -> DataFrame:
    return screened.filter(F.col("reason").isNotNull())
