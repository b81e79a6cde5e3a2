"""The producing half: landed responses to published messages."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rollbook.fixed import MAX_ATTEMPTS, QUOTA, TOPIC, USER_COLUMNS
from rollbook.functions.identifiers import keyed_id, random_id
from rollbook.operators.attempts import judged_attempts
from rollbook.operators.flatten import flatten
from rollbook.operators.ranking import best_per_key
from rollbook.operators.wire import encode_messages
from rollbook.sinks.staging import ACCEPTED, EXHAUSTED, PENDING, REJECTED, Staging
from rollbook.streaming.ingest import query_id


@dataclass(frozen=True)
class ProduceReport:
    """How many requests a run went through, by outcome, and how many records it published."""

    accepted: int
    rejected: int
    exhausted: int
    pending: int
    published: int


def resolve_requests(
    responses: DataFrame, max_attempts: int = MAX_ATTEMPTS, keyed: bool = False
) -> DataFrame:
    """One row per request with its `outcome`; accepted ones carry the flat record.

    A request is accepted or rejected by its first valid attempt, exhausted when all
    allowed attempts failed, and pending while it has attempts left; `attempts` is
    the number that were needed to know. Responses that name no request are one row,
    rejected. Bodies are parsed once, and flattened before the only shuffle, which
    then moves flat records instead of responses.
    """
    return _outcomes(_decisive(_flat_attempts(responses, max_attempts)), max_attempts, keyed)


def _flat_attempts(responses: DataFrame, max_attempts: int) -> DataFrame:
    valid = F.col("valid")
    return flatten(judged_attempts(responses, max_attempts)).select(
        "request_id",
        "attempt",
        "valid",
        "answer",
        F.when(valid, F.col("reason")).alias("reason"),
        F.when(valid & F.col("reason").isNotNull(), F.to_json("user")).alias("document"),
        *USER_COLUMNS[1:],
    )


def _decisive(attempts: DataFrame) -> DataFrame:
    """Valid attempts first, in order; without one, the last failure. Ties are settled by content."""
    attempt, valid = F.col("attempt"), F.col("valid")
    return best_per_key(
        attempts, "request_id", valid.desc(), F.when(valid, attempt), attempt.desc(), F.col("answer")
    )


def _outcomes(decisive: DataFrame, max_attempts: int, keyed: bool, *keep: str) -> DataFrame:
    attempt, valid, named = F.col("attempt"), F.col("valid"), F.col("request_id").isNotNull()
    outcome = (
        F.when(~named, F.lit(REJECTED))
        .when(valid & F.col("reason").isNull(), F.lit(ACCEPTED))
        .when(valid, F.lit(REJECTED))
        .when(attempt >= max_attempts, F.lit(EXHAUSTED))
        .otherwise(F.lit(PENDING))
    )
    accepted = F.col("outcome") == ACCEPTED
    record_id = keyed_id(F.col("request_id")) if keyed else random_id()
    return decisive.withColumn("outcome", outcome).select(
        "request_id",
        attempt.alias("attempts"),
        "outcome",
        F.when(named, F.col("reason")).otherwise(F.lit("request_id is missing")).alias("reason"),
        "document",
        F.when(accepted, record_id).alias("id"),
        *[F.when(accepted, F.col(name)).alias(name) for name in USER_COLUMNS[1:]],
        *keep,
    )


def take_quota(users: DataFrame, quota: int = QUOTA) -> DataFrame:
    """The first `quota` records in request order; rejected documents do not use it up."""
    return users.orderBy("request_id").limit(quota)


def nth_request(requests: DataFrame, n: int, direct: int = 1000, k: int = 1024) -> int | None:
    """The n-th `request_id` in order, None when there are fewer; rows without one do not count.

    While more than `direct` ids come before it, a quantile sketch of the ids (`k` is its size) gives two of them
    that enclose it, the ids before and between are counted, and the search goes on between. What is found is
    exact, since the counts are. Every pass sends one row per task, the last one up to `direct` ids; none shuffles.
    """
    request = F.col("request_id")
    inside = requests.select("request_id").filter(request.isNotNull())
    while n > direct:
        size = F.count("request_id")
        sketched = inside.agg(size.alias("size"), F.kll_sketch_agg_bigint("request_id", F.lit(k)).alias("sketch"))
        total, sketch = sketched.first()
        if n > total:
            return None
        # Ranks err by less than a hundredth at this size of the sketch.
        ranks = [min(max(n / total + side, 0.0), 1.0) for side in (-0.01, 0.01)]
        quantiles = [F.kll_sketch_get_quantile_bigint(F.lit(sketch), F.lit(rank)) for rank in ranks]
        low, high = requests.sparkSession.range(1).select(*quantiles).first()
        before, between = inside.agg(F.count_if(request < low), F.count_if(request.between(low, high))).first()
        if n <= before:
            inside = inside.filter(request < low)
        elif n > before + between:
            inside, n = inside.filter(request > high), n - before - between
        elif low == high:
            return low
        else:
            inside, n = inside.filter(request.between(low, high)), n - before
            if between == total:  # the same few ids again and again
                break
    found = inside.orderBy("request_id").limit(n).agg(F.count("request_id"), F.max("request_id")).first()
    return found[1] if found[0] == n else None


def resolve_batch(
    responses: DataFrame,
    staging: Staging,
    query: str,
    batch_id: int,
    keyed: bool = False,
    max_attempts: int = MAX_ATTEMPTS,
    spread: bool = False,
) -> None:
    """Add the outcomes of a batch of responses to what earlier batches left in `staging`.

    `spread` deals the responses out to all cores before they are parsed: a batch of few files may be few splits,
    however large, since a row group is never read by two tasks, and parsing takes far longer than moving the text.

    Requests that are decided stay as they are; open ones go on from the attempts they
    have had, and are written again only if the batch knows more of them. A batch that was
    committed before is left alone, so its ids are final. Of earlier requests only those in
    the batch's range are read.
    """
    if staging.has(query, batch_id):
        return
    dealt = responses.repartition(responses.sparkSession.sparkContext.defaultParallelism) if spread else responses
    attempts = _flat_attempts(dealt, max_attempts).withColumn("waited", F.lit(False))
    if staging.last_version() < 0:
        staging.commit(_outcomes(_decisive(attempts), max_attempts, keyed, "waited"), query, batch_id)
        return
    low, high = responses.agg(F.min("request_id"), F.max("request_id")).first()
    earlier = staging.resolved().filter(F.col("request_id").between(F.lit(low), F.lit(high)))
    waiting = earlier.filter(F.col("outcome") == PENDING).select(
        "request_id", F.col("attempts").alias("attempt"), F.lit(False).alias("valid"), F.lit(True).alias("waited")
    )
    newest = _decisive(attempts.unionByName(waiting, allowMissingColumns=True)).filter(~F.col("waited")).drop("waited")
    decided = earlier.filter(F.col("outcome") != PENDING).select("request_id")
    fresh = newest.join(decided, "request_id", "left_anti").join(waiting.select("request_id", "waited"), "request_id", "left")
    fresh = fresh.withColumn("waited", F.coalesce("waited", F.lit(False)))
    staging.commit(_outcomes(fresh, max_attempts, keyed, "waited"), query, batch_id)


def publish_run(
    staging: Staging,
    publish: Callable[[DataFrame], None],
    quota: int | None = QUOTA,
    topic: str = TOPIC,
) -> ProduceReport:
    """One run: the first `quota` accepted records that no run has sent, and a report of what was gone through.

    What a run sends is settled before it sends. A run that failed is finished first,
    with the same records and ids, and is then the run; more waits for the next one.
    """
    runs = staging.runs()
    if runs and not staging.is_sent(runs[-1]):
        run, before = runs[-1], runs[:-1]
    elif quota == 0:
        publish(encode_messages(staging.resolved().limit(0), topic))
        return ProduceReport(0, 0, 0, 0, 0)
    else:
        left = staging.left_by(runs).filter(F.col("outcome") == ACCEPTED)
        last = None if quota is None else nth_request(left, quota)
        number = runs[-1].number + 1 if runs else 0
        run, before = staging.begin(number, staging.last_version(), last), runs
    # One pass sends the accepted records and counts what it goes through.
    outcomes = [ACCEPTED, REJECTED, EXHAUSTED, PENDING]
    gone = Observation("gone through")
    counts = [F.count_if(F.col("outcome") == name).alias(name) for name in outcomes]
    through = staging.left_by(before).filter(run.reaches()).observe(gone, *counts)
    publish(encode_messages(through.filter(F.col("outcome") == ACCEPTED), topic))
    staging.finish(run)
    return ProduceReport(**gone.get, published=gone.get[ACCEPTED])


def produce(
    responses: DataFrame,
    publish: Callable[[DataFrame], None],
    staging: str,
    quota: int | None = QUOTA,
    topic: str = TOPIC,
    keyed: bool = False,
) -> ProduceReport:
    """Resolve `responses` into `staging`, publish a run's accepted records, and report the counts.

    All responses are resolved, once. With a quota the run goes through the requests
    in order until it is filled, and the report covers those; what it does not reach
    remains in `staging` for the next run. Given the same staging again, requests that
    are decided are not resolved or sent again.
    """
    state = Staging(responses.sparkSession, staging)
    resolve_batch(responses, state, uuid.uuid4().hex, 0, keyed)
    return publish_run(state, publish, quota, topic)


def drain_responses(
    responses: DataFrame,
    publish: Callable[[DataFrame], None],
    staging: str,
    checkpoint: str,
    quota: int | None = QUOTA,
    topic: str = TOPIC,
    keyed: bool = False,
) -> ProduceReport:
    """A scheduled run: resolve the responses landed since the last run, publish a quota, and end.

    `responses` is a stream of the landing zone and `checkpoint` remembers what was
    taken, in batches as large as the source's caps allow. The quota is one for the
    run, whatever the number of batches; days without a run are not made up for.
    Attempts of one request may land in different runs.
    """
    state = Staging(responses.sparkSession, staging)

    def run(batch: DataFrame, batch_id: int) -> None:
        resolve_batch(batch, state, query_id(responses.sparkSession, checkpoint), batch_id, keyed, spread=True)

    query = (
        responses.observe("landed", F.count(F.lit(1)).alias("responses"))
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(run)
        .start()
    )
    query.awaitTermination()
    return publish_run(state, publish, quota, topic)
