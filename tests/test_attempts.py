"""One usable response per request: rules, plans, and requests with very many attempts."""

import json
import random
import uuid

import pytest
from pyspark.sql import functions as F

from rollbook.fixed import USER_COLUMNS
from rollbook.operators.attempts import (
    exhausted_requests,
    first_valid_attempt,
    judged_attempts,
    valid_attempts,
)
from rollbook.plans.produce import resolve_requests, take_quota
from rollbook.schema import RESPONSE_SCHEMA
from rollbook.sources.responses import read_responses


def body(name):
    return json.dumps({"results": [{"login": {"username": name}}]})


BROKEN = json.dumps({"results": [{"login": None}]})


@pytest.fixture(scope="module")
def attempts():
    """Random attempts: up to 8 per request, each good, unflattenable, or bad in some way."""
    rng = random.Random(7)
    rows = []
    for request in range(300):
        for attempt in range(1, rng.randint(1, 8) + 1):
            kind = rng.choice(["good", "broken", "status", "empty", "text", "none", "lost"])
            text = {
                "good": body(f"u{request}.{attempt}"),
                "broken": BROKEN,
                "status": body("unseen"),
                "empty": '{"results":[]}',
                "text": "nope",
                "none": None,
                "lost": None,
            }[kind]
            status = {"status": 503, "lost": None}.get(kind, 200)
            rows.append((request, attempt, status, text, kind))
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def landed(spark, attempts):
    return spark.createDataFrame([row[:4] for row in attempts], RESPONSE_SCHEMA).repartition(5)


def expected(attempts):
    """request -> (outcome, attempts needed, user name), by going through the rows."""
    by_request = {}
    for request, attempt, _, _, kind in attempts:
        if attempt <= 5:
            by_request.setdefault(request, {})[attempt] = kind
    out = {}
    for request, kinds in by_request.items():
        good = [n for n in sorted(kinds) if kinds[n] in ("good", "broken")]
        if good and kinds[good[0]] == "good":
            out[request] = ("accepted", good[0], f"u{request}.{good[0]}")
        elif good:
            out[request] = ("rejected", good[0], None)
        elif max(kinds) == 5:
            out[request] = ("exhausted", 5, None)
        else:
            out[request] = ("pending", max(kinds), None)
    return out


def test_every_outcome(attempts, landed):
    rows = resolve_requests(landed).collect()
    found = {row.request_id: (row.outcome, row.attempts, row.user_name) for row in rows}
    assert found == expected(attempts)
    assert len(rows) == len(found)
    assert {row.outcome for row in rows} == {"accepted", "rejected", "exhausted", "pending"}
    for row in rows:
        assert (row.id is not None) == (row.outcome == "accepted")
        assert row.reason == ("login is not an object" if row.outcome == "rejected" else None)
        assert (row.document is not None) == (row.outcome == "rejected")


def test_first_valid_attempt_agrees(attempts, landed):
    rows = first_valid_attempt(valid_attempts(landed)).collect()
    assert {row.request_id: row.attempt for row in rows} == {
        request: n
        for request, (outcome, n, _) in expected(attempts).items()
        if outcome in ("accepted", "rejected")
    }


def test_exhausted_agrees(attempts, landed):
    rows = exhausted_requests(landed).collect()
    assert {row.request_id for row in rows} == {
        request
        for request, (outcome, _, _) in expected(attempts).items()
        if outcome == "exhausted"
    }
    assert {row.attempts for row in rows} == {5}


def test_request_that_never_got_an_answer_is_exhausted(spark):
    rows = [(1, n, None, None) for n in range(1, 6)] + [(2, n, None, None) for n in range(1, 5)]
    landed = spark.createDataFrame(rows, RESPONSE_SCHEMA)
    assert [tuple(row) for row in exhausted_requests(landed).collect()] == [(1, 5)]
    outcomes = {row.request_id: row.outcome for row in resolve_requests(landed).collect()}
    assert outcomes == {1: "exhausted", 2: "pending"}
    assert judged_attempts(landed).filter("NOT valid").count() == 9


def test_judged_attempts_keep_every_allowed_attempt(attempts, landed):
    rows = judged_attempts(landed).select("request_id", "attempt", "valid").collect()
    assert {tuple(row) for row in rows} == {
        (request, attempt, kind in ("good", "broken"))
        for request, attempt, _, _, kind in attempts
        if attempt <= 5
    }


def test_quota_skips_rejects_and_keeps_request_order(attempts, landed):
    users = resolve_requests(landed).filter(F.col("outcome") == "accepted")
    rows = take_quota(users, 20).collect()
    good = sorted(r for r, (outcome, _, _) in expected(attempts).items() if outcome == "accepted")
    assert [row.request_id for row in rows] == good[:20]


def test_ids_are_random_unless_keyed(landed):
    def ids(keyed):
        rows = resolve_requests(landed, keyed=keyed).collect()
        return {row.request_id: row.id for row in rows if row.id}

    assert ids(True) == ids(True)
    first = ids(False)
    assert {uuid.UUID(value).version for value in first.values()} == {4}
    assert len(set(first.values())) == len(first)


# --- plans and scale --------------------------------------------------------------------


@pytest.fixture(scope="module")
def landing(spark, landed, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landing") / "responses")
    landed.write.parquet(path)
    return read_responses(spark, path)


def test_status_and_attempt_filters_reach_the_scan(landing, plan):
    text = plan(first_valid_attempt(valid_attempts(landing)))
    assert "EqualTo(status,200)" in text
    assert "LessThanOrEqual(attempt,5)" in text


def test_unused_body_columns_are_not_read(landing, plan):
    text = plan(valid_attempts(landing).select("request_id"))
    assert "ReadSchema: struct<request_id:bigint,status:int,body:string>" in text


def test_bodies_are_parsed_once_and_shuffled_once(landing, plan):
    for frame in (
        valid_attempts(landing),
        first_valid_attempt(valid_attempts(landing)),
        resolve_requests(landing),
        resolve_requests(landing).filter(F.col("outcome") == "accepted"),
    ):
        text = plan(frame)
        assert text.count("from_json") == 1
        assert text.count("Exchange") <= 1


def test_resolution_shuffles_flat_records_not_bodies(landing, plan):
    text = plan(resolve_requests(landing))
    above_scan = text[: text.index("Exchange")]
    below = text[text.index("Exchange") :]
    assert "body" not in above_scan
    assert below.index("WindowGroupLimit") < below.index("from_json")


def test_each_task_sends_one_row_per_request(landing, plan):
    for frame in (first_valid_attempt(valid_attempts(landing)), resolve_requests(landing)):
        text = plan(frame)
        below = text[text.index("Exchange") :]
        assert "row_number(), 1, Partial" in below


def test_bucketed_landing_needs_no_shuffle(spark, landed, plan):
    landed.write.mode("overwrite").bucketBy(4, "request_id").saveAsTable("landed_bucketed")
    try:
        frame = resolve_requests(spark.table("landed_bucketed"))
        assert "Exchange" not in plan(frame)
        assert frame.count() == landed.select("request_id").distinct().count()
    finally:
        spark.sql("DROP TABLE landed_bucketed")


def test_one_request_with_a_third_of_all_rows(spark):
    """A request retried without end is one row like any other."""
    good, bad = body("late"), '{"results":[]}'
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("request_id"),
        F.when(F.col("id") % 3 == 0, F.col("id") / 3 + 1).otherwise(F.lit(1)).cast("int").alias(
            "attempt"
        ),
        F.lit(200).alias("status"),
        F.when(F.col("id") % 3 == 0, F.when(F.col("id") >= 6, good).otherwise(bad))
        .otherwise(F.lit(good))
        .alias("body"),
    )
    resolved = resolve_requests(rows.repartition(8), max_attempts=10_000)
    assert resolved.count() == 4001
    hot = resolved.filter(F.col("request_id") == 0).first()
    assert (hot.outcome, hot.attempts) == ("accepted", 3)
    assert tuple(resolved.columns[-len(USER_COLUMNS) :]) == USER_COLUMNS


def test_landed_responses_stream(spark, landed, tmp_path):
    """The same steps run on a stream of landed files."""
    landed.write.parquet(str(tmp_path / "landing"))
    stream = valid_attempts(read_responses(spark, str(tmp_path / "landing"), streaming=True))
    query = (
        stream.select("request_id", "attempt")
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    out = {tuple(row) for row in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = valid_attempts(landed).select("request_id", "attempt").collect()
    assert out == {tuple(row) for row in batch}
