"""The producing job, the table, the session, and the command line."""

import json
from dataclasses import asdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rollbook.__main__ import main
from rollbook.fixed import DATABASE, STORE_PACING, TABLE, USER_COLUMNS
from rollbook.operators.wire import decode_messages, encode_messages
import rollbook.plans.produce as plans
from rollbook.plans.fixtures import landed_responses
from rollbook.plans.produce import drain_responses, nth_request, produce, resolve_requests
from rollbook.schema import MESSAGE_SCHEMA, RESPONSE_SCHEMA, USER_SCHEMA
from rollbook.session import SessionOptions, build_session, shared_folder
from rollbook.sinks.messages import kafka_sink_options, publish_files, publish_kafka
from rollbook.sinks.staging import Staging
from rollbook.sources.messages import file_caps, read_message_files
from rollbook.sources.responses import read_responses


def response(request, kind="good"):
    user = {"login": {"username": f"u{request}"}, "name": {"first": "A", "last": str(request)}}
    text = {
        "good": json.dumps({"results": [user]}),
        "broken": json.dumps({"results": [{"name": 1}]}),
        "empty": '{"results":[]}',
    }[kind]
    attempts = 5 if kind == "empty" else 1
    return [(request, n, 200, text) for n in range(1, attempts + 1)]


def responses(spark, kinds):
    rows = [row for request, kind in kinds.items() for row in response(request, kind)]
    return spark.createDataFrame(rows, RESPONSE_SCHEMA)


KINDS = {n: ("broken" if n % 7 == 0 else "empty" if n % 5 == 0 else "good") for n in range(60)}
GOOD = [n for n, kind in KINDS.items() if kind == "good"]


def published(spark, path):
    return decode_messages(read_message_files(spark, path, streaming=False)).collect()


def test_one_run_publishes_the_quota(spark, tmp_path):
    """It goes through the requests in order until the quota is filled, and counts those."""
    out, staging = str(tmp_path / "out"), str(tmp_path / "staging")
    report = produce(responses(spark, KINDS), lambda m: publish_files(m, out), staging)
    needed = [KINDS[n] for n in range(GOOD[19] + 1)]
    assert asdict(report) == {
        "accepted": 20,
        "rejected": needed.count("broken"),
        "exhausted": needed.count("empty"),
        "pending": 0,
        "published": 20,
    }
    rows = published(spark, out)
    assert {row.user_name for row in rows} == {f"u{n}" for n in GOOD[:20]}
    staged = Staging(spark, staging).progress().collect()
    assert len(staged) == len(KINDS)  # every outcome, whatever the quota
    ids = {row.user_name: row.id for row in staged if row.id}
    assert all(ids[row.user_name] == row.id for row in rows)


@pytest.mark.parametrize("n", [1, 5, 20, 59, 60, 61])
@pytest.mark.parametrize("direct", [0, 7, 1000])
def test_nth_request(spark, n, direct):
    frame = spark.createDataFrame([(7 * i % 60,) for i in range(60)] + [(None,)], "request_id long").repartition(5)
    assert nth_request(frame, n, direct) == (n - 1 if n <= 60 else None)
    assert nth_request(frame.limit(0), n, direct) is None


@pytest.mark.parametrize("n", [1, 999, 1000, 12_345, 60_000, 119_999, 120_000, 120_001])
def test_nth_request_of_many(spark, n):
    """The sketch of a hundred thousand ids, uneven ones, some of them often."""
    ids = [i * i for i in range(90_000)] + [5_000_000] * 20_000 + [-7] * 10_000
    frame = spark.createDataFrame([(i,) for i in ids], "request_id long").repartition(6)
    assert nth_request(frame, n, direct=100, k=256) == (sorted(ids)[n - 1] if n <= len(ids) else None)


def test_nth_request_shuffles_no_ids(spark, monkeypatch):
    """Every frame that a search collects moves to one task what a task has reduced first."""
    plans = []
    first = type(spark.range(0)).first

    def seen(frame):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return first(frame)

    monkeypatch.setattr(type(spark.range(0)), "first", seen)
    frame = spark.range(100_000).selectExpr("id * 3 as request_id")
    assert nth_request(frame, 70_000, direct=10) == 69_999 * 3
    assert len(plans) > 3
    for text in plans:
        assert "rangepartitioning" not in text and "hashpartitioning" not in text
        assert text.count("Exchange SinglePartition") <= 2 and "+- Sort [" not in text


def test_runs_go_on_where_the_last_stopped(spark, tmp_path):
    """Nothing is lost to the quota: the rest goes out in later runs, in order, each request once."""
    out, staging = str(tmp_path / "out"), str(tmp_path / "staging")
    sizes = []
    for _ in range(4):
        produce(responses(spark, KINDS), lambda m: publish_files(m, out), staging, quota=15)
        sizes.append(len(published(spark, out)))
    assert sizes == [15, 30, len(GOOD), len(GOOD)]
    assert len({row.id for row in published(spark, out)}) == len(GOOD)
    runs = {row.user_name: row.run for row in Staging(spark, staging).progress().collect() if row.id}
    assert [runs[f"u{n}"] for n in GOOD] == [i // 15 for i in range(len(GOOD))]


def test_late_requests_before_the_last_one_go_out_too(spark, tmp_path):
    out, staging = str(tmp_path / "out"), str(tmp_path / "staging")
    for kinds in ({n: "good" for n in range(10, 20)}, {n: "good" for n in range(0, 30)}, {}):
        produce(responses(spark, kinds), lambda m: publish_files(m, out), staging, quota=8)
    names = [row.user_name for row in published(spark, out)]
    assert sorted(names) == sorted({*names}) and len(names) == 24
    remaining = Staging(spark, staging).progress().filter("run IS NULL").collect()
    assert sorted(row.request_id for row in remaining) == list(range(24, 30))


def test_request_without_a_number_is_rejected(spark, tmp_path):
    rows = [(None, 1, 200, response(1)[0][3]), *response(2)]
    frame = spark.createDataFrame(rows, RESPONSE_SCHEMA)
    for quota in (1, None, 5000):
        out = str(tmp_path / f"out-{quota}")
        produce(frame, lambda m: publish_files(m, out), str(tmp_path / f"staging-{quota}"), quota)  # noqa: B023
        assert [row.user_name for row in published(spark, out)] == ["u2"]
        outcomes = Staging(spark, str(tmp_path / f"staging-{quota}")).progress().collect()
        assert {(r.request_id, r.outcome) for r in outcomes} == {(None, "rejected"), (2, "accepted")}


def test_the_same_attempt_with_two_answers(spark):
    rows = [(n, 1, 200, response(n)[0][3].replace("A", x)) for n in range(40) for x in "ABC"]
    frame = spark.createDataFrame(rows, RESPONSE_SCHEMA)
    found = {
        tuple(sorted((r.request_id, r.full_name) for r in resolve_requests(frame.repartition(n, *by)).collect()))
        for n, by in ((1, []), (3, ["body"]), (7, []), (5, ["request_id"]))
    }
    assert len(found) == 1


def test_fewer_records_than_the_quota(spark, tmp_path):
    out = str(tmp_path / "out")
    report = produce(
        responses(spark, {1: "good", 2: "broken"}),
        lambda m: publish_files(m, out),
        str(tmp_path / "staging"),
    )
    assert report.published == 1
    assert len(published(spark, out)) == 1


@pytest.mark.parametrize("quota", [20, None, 0])
@pytest.mark.parametrize("kinds", [{}, {1: "broken"}, {1: "empty"}])
def test_nothing_to_publish(spark, tmp_path, kinds, quota):
    out = str(tmp_path / "out")
    report = produce(
        responses(spark, kinds), lambda m: publish_files(m, out), str(tmp_path / "s"), quota
    )
    assert (report.accepted, report.published) == (0, 0)
    assert report.rejected + report.exhausted == (0 if quota == 0 else len(kinds))
    assert published(spark, out) == []


def test_no_quota_publishes_everything_to_the_named_topic(spark, tmp_path):
    out = str(tmp_path / "out")
    report = produce(
        responses(spark, KINDS).repartition(3),
        lambda m: publish_files(m, out),
        str(tmp_path / "staging"),
        quota=None,
        topic="elsewhere",
        keyed=True,
    )
    assert report.published == len(GOOD)
    messages = read_message_files(spark, out, "elsewhere", streaming=False)
    assert messages.count() == len(GOOD)
    assert read_message_files(spark, out, streaming=False).count() == 0


def test_published_files_have_the_envelope(spark, tmp_path):
    out = str(tmp_path / "out")
    record = dict.fromkeys(USER_COLUMNS, "x")
    users = spark.createDataFrame([record] * 50, USER_SCHEMA).repartition(3)
    for _ in range(2):
        publish_files(encode_messages(users), out)
    written = spark.read.parquet(out)
    assert [(f.name, f.dataType) for f in written.schema] == [
        (f.name, f.dataType) for f in MESSAGE_SCHEMA
    ]
    places = written.select("timestamp", "partition", "offset").distinct()
    assert written.count() == places.count() == 100
    assert written.filter("key IS NOT NULL OR timestampType <> 0").count() == 0


def test_scheduled_run_takes_only_what_landed_since(spark, tmp_path):
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")

    def run():
        drain_responses(
            read_responses(spark, landing, streaming=True),
            lambda m: publish_files(m, out),
            str(tmp_path / "staging"),
            str(tmp_path / "checkpoint"),
            quota=None,
        )
        return sorted(row.user_name for row in published(spark, out))

    responses(spark, {1: "good", 2: "good"}).write.mode("append").parquet(landing)
    assert run() == ["u1", "u2"]
    assert run() == ["u1", "u2"]
    responses(spark, {3: "good"}).write.mode("append").parquet(landing)
    assert run() == ["u1", "u2", "u3"]


class Scheduled:
    """A landing zone and its runs; `fails` breaks a run after it has published."""

    def __init__(self, spark, folder, **settings):
        self.spark, self.folder, self.settings = spark, folder, settings

    def land(self, rows):
        self.spark.createDataFrame(rows, RESPONSE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.folder}/landing")

    def run(self, fails=False):
        def publish(messages):
            publish_files(messages, f"{self.folder}/out")
            if fails:
                raise ConnectionError("lost after publishing")

        landed = read_responses(self.spark, f"{self.folder}/landing", streaming=True, caps=file_caps(1))
        return drain_responses(landed, publish, f"{self.folder}/staging", f"{self.folder}/checkpoint", **self.settings)

    def published(self):
        return published(self.spark, f"{self.folder}/out")

    def outcomes(self):
        rows = Staging(self.spark, f"{self.folder}/staging").progress().collect()
        return {r.request_id: (r.outcome, r.attempts) for r in rows}


def test_quota_is_per_run_whatever_the_batches(spark, tmp_path):
    job = Scheduled(spark, str(tmp_path), quota=5)
    for start in (0, 4, 8, 12):
        job.land([row for n in range(start, start + 4) for row in response(n)])
    assert job.run().published == 5  # four batches
    assert job.run().published == 5  # nothing landed
    with pytest.raises(ConnectionError):
        job.run(fails=True)
    job.land([row for n in range(16, 20) for row in response(n)])
    assert job.run().published == 5  # the failed run, finished; its messages are there twice
    names = [row.user_name for row in job.published()]
    assert {*names} == {f"u{n}" for n in range(15)}
    assert len({row.id for row in job.published()}) == 15
    assert job.run().published == 5
    assert job.run().published == 0
    assert {row.user_name for row in job.published()} == {f"u{n}" for n in range(20)}


def test_attempts_over_several_runs(spark, tmp_path):
    good = response(1)[0][3]
    job = Scheduled(spark, str(tmp_path), quota=None)
    job.land([(1, 1, 500, None), (2, 1, 200, good), (3, 1, 500, None), (3, 2, 500, None)])
    job.run()
    assert job.outcomes() == {1: ("pending", 1), 2: ("accepted", 1), 3: ("pending", 2)}
    job.land([(1, 2, 200, good), (2, 2, 200, good), (3, 3, 500, None), (2, 1, 200, good)])
    job.run()
    assert job.outcomes() == {1: ("accepted", 2), 2: ("accepted", 1), 3: ("pending", 3)}
    job.land([(2, 5, 500, None), (3, 4, 500, None), (3, 5, 500, None), (1, 3, 200, good)])
    job.run()
    assert job.outcomes() == {1: ("accepted", 2), 2: ("accepted", 1), 3: ("exhausted", 5)}
    assert len(job.published()) == 2


def test_a_repeated_batch_keeps_its_ids(spark, tmp_path):
    """A stream that lost the commit of a batch gives it again; what it decided stands."""
    job = Scheduled(spark, str(tmp_path), quota=None)
    job.land([row for n in range(6) for row in response(n)])
    job.run()
    before = sorted((r.user_name, r.id) for r in job.published())
    for name in ("0", ".0.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink()
    assert job.run().published == 0
    assert sorted((r.user_name, r.id) for r in job.published()) == before


def test_a_new_checkpoint_sends_nothing_again(spark, tmp_path):
    job = Scheduled(spark, str(tmp_path), quota=None)
    job.land([row for n in range(6) for row in response(n)])
    job.run()
    (tmp_path / "checkpoint").rename(tmp_path / "old")
    job.run()
    assert len(job.published()) == 6


def test_kafka_sink():
    assert kafka_sink_options("broker:1") == {
        "kafka.bootstrap.servers": "broker:1",
        "kafka.acks": "all",
    }


def test_missing_broker_connector_stops_the_job(spark, tmp_path):
    with pytest.raises(Exception, match="kafka"):
        produce(
            responses(spark, {1: "good"}),
            lambda m: publish_kafka(m, kafka_sink_options("broker:1")),
            str(tmp_path / "staging"),
        )


# --- session -----------------------------------------------------------------------------


def test_session_settings(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_store_pacing_is_passed_through(spark):
    session = build_session(SessionOptions(extra=STORE_PACING))
    assert session.conf.get("spark.cassandra.output.concurrent.writes") == "2"
    assert session.conf.get("spark.cassandra.output.throughputMBPerSec") == "10"


def test_shared_folder_is_the_clusters(spark):
    first, second = shared_folder(spark, "log"), shared_folder(spark, "log")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))


# --- command line -------------------------------------------------------------------------


def test_jobs_from_the_command_line(spark, tmp_path, capsys):
    def path(name):
        return str(tmp_path / name)

    responses(spark, KINDS).write.parquet(path("landing"))
    main(
        ["produce", "--responses", path("landing"), "--staging", path("staging")]
        + ["--out", path("messages"), "--quota", "0", "--keyed-ids"]
    )
    assert f"'published': {len(GOOD)}" in capsys.readouterr().out
    main(
        ["consume", "--messages", path("messages"), "--log", path("log")]
        + ["--checkpoint", path("checkpoint"), "--table-folder", path("table")]
        + ["--buckets", "4", "--drain", "--max-bytes-per-trigger", "1000000"]
    )
    main(["compact", "--log", path("log"), "--target", path("compacted")])
    for log in ("log", "compacted"):
        main(["merge", "--log", path(log), "--table-folder", path("table")])
        rows = spark.table(f"{DATABASE}.{TABLE}").collect()
        assert sorted(row.user_name for row in rows) == sorted(f"u{n}" for n in GOOD)


def test_scheduled_run_from_the_command_line(spark, tmp_path):
    def path(name):
        return str(tmp_path / name)

    responses(spark, KINDS).write.json(path("landing"))
    for _ in range(2):
        main(
            ["produce", "--responses", path("landing"), "--format", "json"]
            + ["--staging", path("staging"), "--out", path("messages")]
            + ["--checkpoint", path("checkpoint"), "--max-files-per-trigger", "1"]
        )
    assert len(GOOD) == 41
    assert len(published(spark, path("messages"))) == 40


def test_flags_that_do_not_apply_are_refused(capsys):
    consume = ["consume", "--log", "l", "--checkpoint", "c", "--table-folder", "t"]
    produce = ["produce", "--responses", "r", "--staging", "s", "--out", "o"]
    for argv in (
        [*consume, "--messages", "m", "--max-per-trigger", "10"],
        [*consume, "--messages", "m", "--min-partitions", "4"],
        [*consume, "--servers", "b", "--max-files-per-trigger", "4"],
        [*consume, "--messages", "m", "--max-files-per-trigger", "4", "--max-bytes-per-trigger", "1000"],
        [*produce, "--max-files-per-trigger", "4"],
    ):
        with pytest.raises(SystemExit):
            main(argv)
    assert "does not apply" in capsys.readouterr().err


def test_command_line_needs_its_paths(capsys):
    with pytest.raises(SystemExit):
        main(["consume", "--messages", "somewhere"])
    assert "--checkpoint" in capsys.readouterr().err


def test_unavailable_source_ends_the_command_with_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="kafka"):
        main(
            ["consume", "--servers", "broker:1", "--log", str(tmp_path / "log")]
            + ["--checkpoint", str(tmp_path / "c"), "--table-folder", str(tmp_path / "t")]
        )
    assert not Path(tmp_path / "log").exists()


# --- how a batch is dealt out ---------------------------------------------------------------


def test_a_batch_of_one_split_is_parsed_by_all_cores(spark, tmp_path, monkeypatch):
    """A landed file with one row group, whatever its size, is one task's."""
    seen, flat = [], plans._flat_attempts

    def parsed(responses, max_attempts):
        seen.append({r.p: r.n for r in responses.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()})
        return flat(responses, max_attempts)

    monkeypatch.setattr(plans, "_flat_attempts", parsed)
    job = Scheduled(spark, str(tmp_path), quota=None)
    job.land([row for n in range(400) for row in response(n)])
    assert job.run().published == 400
    assert len(seen) == 1 and len(seen[0]) == spark.sparkContext.defaultParallelism and max(seen[0].values()) < 200


def test_responses_of_a_compact_table_are_made_by_all_cores(spark, tmp_path):
    customers = spark.range(400).selectExpr("id as c_custkey", "'C#' || id as c_name", "1 as c_nationkey", "'M' as c_mktsegment")
    customers.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    made = landed_responses(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count()
    assert made.count() == spark.sparkContext.defaultParallelism


# --- what a batch writes -------------------------------------------------------------------


def test_a_batch_writes_no_more_than_it_brings(spark, tmp_path):
    """Open requests that a batch does not try are not written again, however many there are."""
    job = Scheduled(spark, str(tmp_path), quota=None)
    job.land([(n, 1, 500, None) for n in range(300)])
    job.run()
    job.land([(5, 2, 500, None), (7, 2, 200, response(7)[0][3]), (9, 1, 500, None), (400, 1, 500, None)])
    job.run()
    version = spark.read.parquet(f"{tmp_path}/staging/resolved/version=1")
    # 9 brought the attempt that was known: which of two equal rows counts is open, its outcome is not.
    assert {r.request_id for r in version.collect()} - {9} == {5, 7, 400}
    outcomes = job.outcomes()
    assert len(outcomes) == 301 and outcomes[5] == ("pending", 2) and outcomes[7] == ("accepted", 2)
    assert outcomes[9] == ("pending", 1) and outcomes[400] == ("pending", 1)
    job.land([(5, n, 500, None) for n in (3, 4, 5)] + [(8, 1, 200, response(8)[0][3])])
    report = job.run()
    assert (report.published, report.pending, report.exhausted) == (1, 298, 1)
    outcomes = job.outcomes()
    assert outcomes[5] == ("exhausted", 5) and outcomes[8] == ("accepted", 1)
    assert sum(o == "pending" for o, _ in outcomes.values()) == 298
