"""Keyed-table semantics over an append-only log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.fixed import USER_COLUMNS
from rollbook.operators.ranking import best_per_key
from rollbook.operators.screening import rejected, storable
from rollbook.schema import POSITION


def latest_versions(log: DataFrame) -> DataFrame:
    """One row per id of the storable log rows, the one at the highest position, position included.

    Writing a message again adds an equal row at an equal position, so replays do
    not change the result.
    """
    rows = storable(log).select(*USER_COLUMNS, *POSITION)
    return best_per_key(rows, "id", *[F.col(name).desc() for name in POSITION])


def current_users(log: DataFrame) -> DataFrame:
    """The table as its readers see it: one current row per id."""
    return latest_versions(log).select(*USER_COLUMNS)


def rejected_messages(log: DataFrame) -> DataFrame:
    """The messages set aside, once each however often they were replayed."""
    return rejected(log).select("id", *POSITION, "reason", "value").dropDuplicates(list(POSITION))
