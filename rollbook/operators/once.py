"""Keeping an expensive expression from being repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """`rows` with the column `name`, computed once per row whatever is done with it.

    It is written as the explode of a one-element array. As a plain projection, a
    later filter on anything derived from the column is pushed below it and computes
    `value` again for every reference; for a JSON parse that doubles the run time.
    """
    return rows.select("*", F.explode(F.array(value)).alias(name))
