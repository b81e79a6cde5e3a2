"""From landed fetch attempts to one usable response per request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.fixed import MAX_ATTEMPTS
from rollbook.functions.documents import results
from rollbook.operators.ranking import best_per_key


def valid_attempts(responses: DataFrame) -> DataFrame:
    """Attempts that answered 200 with a non-empty `results` list, with its first element as `user`.

    Exploding at most one element tests the list and takes from it in one parse:
    a filter on the parsed list would be pushed below the projection and parse again.
    """
    first = F.slice(results(F.col("body")), 1, 1)
    return responses.filter(F.col("status") == 200).select("*", F.explode(first).alias("user"))


def first_valid_attempt(attempts: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """The earliest valid attempt of every request, among the allowed number.

    An attempt that landed more than once with different answers counts with the one
    that comes first by content, whatever the order of the rows.
    """
    allowed = attempts.filter(F.col("attempt") <= max_attempts)
    return best_per_key(allowed, "request_id", F.col("attempt"), *content_order())


def content_order() -> list[Column]:
    """Orders answers to one attempt by what they say."""
    return [F.xxhash64("status", "body"), F.md5(F.coalesce("body", F.lit("")))]


def exhausted_requests(responses: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Requests whose allowed attempts were all made and none was valid."""
    valid = _is_valid(F.col("status"), results(F.col("body")))
    return (
        responses.filter(F.col("attempt") <= max_attempts)
        .groupBy("request_id")
        .agg(F.bool_or(valid).alias("answered"), F.max("attempt").alias("attempts"))
        .filter(~F.col("answered") & (F.col("attempts") >= max_attempts))
        .select("request_id", "attempts")
    )


def judged_attempts(responses: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Every allowed attempt with its verdict `valid` and its `user`, from one parse of the body.

    `answer` tells answers to one attempt apart, in an order that depends on them alone.
    """
    return (
        responses.filter(F.col("attempt") <= max_attempts)
        .withColumn("answer", F.struct(*content_order()))
        .withColumn("results", F.when(F.col("status") == 200, results(F.col("body"))))
        .select(
            "request_id",
            "attempt",
            _is_valid(F.col("status"), F.col("results")).alias("valid"),
            F.get("results", F.lit(0)).alias("user"),
            "answer",
        )
    )


def _is_valid(status: Column, found: Column) -> Column:
    """Never NULL: an attempt that got no answer has no status, and is not valid."""
    return status.eqNullSafe(200) & F.coalesce(F.size(found) > 0, F.lit(False))
