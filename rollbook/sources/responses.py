"""Landed API responses."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from rollbook.schema import RESPONSE_SCHEMA


def read_responses(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    streaming: bool = False,
    caps: Mapping[str, str] | None = None,
) -> DataFrame:
    """Fetch attempts landed under `path`, as a batch or as a stream of newly landed files.

    `caps` are options of the file stream: `file_caps`, `file_retirement`.
    """
    reader = spark.readStream.options(**(caps or {})) if streaming else spark.read
    return reader.schema(RESPONSE_SCHEMA).format(format).load(path)
