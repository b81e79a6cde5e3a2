"""The registered queries: one per operator, over whole tables."""

from __future__ import annotations

import contextlib
import time
from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.fixed import TOPIC, USER_COLUMNS
from rollbook.functions.identifiers import is_uuid, keyed_id, random_id
from rollbook.operators.attempts import (
    exhausted_requests,
    first_valid_attempt,
    valid_attempts,
)
from rollbook.operators.flatten import flatten_rejects, flatten_users
from rollbook.operators.latest import current_users, rejected_messages
from rollbook.operators.screening import rejected, screen_messages, storable
from rollbook.operators.wire import decode_messages, encode_messages, message_text
from rollbook.plans.fixtures import (
    event_records,
    landed_responses,
    laned_files,
    message_files,
    message_log,
)
from rollbook.plans.produce import drain_responses, produce, resolve_requests, take_quota
from rollbook.session import shared_folder
from rollbook.sinks.connector import store_writer
from rollbook.sinks.messages import publish_files
from rollbook.sinks.staging import ACCEPTED, Staging
from rollbook.sinks.tables import UserTable, drop_table, ensure_table, merge_log
from rollbook.sinks.user_log import batch_writer, compact_log, read_log
from rollbook.sources.messages import file_caps, read_message_files, record_caps
from rollbook.sources.responses import read_responses
from rollbook.streaming.ingest import drain_messages, drain_together
from rollbook.streaming.progress import progress_told

Query = Callable[[SparkSession, str], DataFrame]


# --- producing half --------------------------------------------------------------


def raw_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = valid_attempts(landed_responses(spark, sf_dir))
    return valid.select("request_id", "attempt", "status", "body")


def first_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = valid_attempts(landed_responses(spark, sf_dir))
    return valid.select("request_id", "attempt", F.to_json("user").alias("user"))


def _first_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_valid_attempt(valid_attempts(landed_responses(spark, sf_dir)))


def first_attempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = _first_users(spark, sf_dir)
    return first.select("request_id", "attempt", F.to_json("user").alias("user"))


def exhausted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exhausted_requests(landed_responses(spark, sf_dir))


def format_user_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_users(_first_users(spark, sf_dir), keyed_id(F.col("request_id")), "request_id")


def format_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_rejects(_first_users(spark, sf_dir), "request_id")


def request_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_requests(landed_responses(spark, sf_dir), keyed=True)


def deterministic_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(
        "event_id",
        keyed_id(F.col("user_id")).alias("user_key"),
        keyed_id(F.col("event_id")).alias("event_key"),
    )


def quota_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = resolve_requests(landed_responses(spark, sf_dir), keyed=True)
    users = resolved.filter(F.col("outcome") == ACCEPTED)
    return take_quota(users).select("request_id", *USER_COLUMNS)


def publish_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "published")
    report = produce(
        landed_responses(spark, sf_dir),
        lambda messages: publish_files(messages, path),
        shared_folder(spark, "staging"),
    )
    return spark.createDataFrame([asdict(report)])


# --- messages -----------------------------------------------------------------------


def wire_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = encode_messages(event_records(spark, sf_dir))
    return messages.select("topic", F.col("value").cast("string").alias("value"))


def topic_subscribe(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = read_message_files(spark, message_files(spark, sf_dir), streaming=False)
    return messages.select("topic", "partition", "offset", F.col("value").cast("string"))


def value_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_text(message_log(spark, sf_dir))


def wire_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_messages(message_log(spark, sf_dir))


def uuid_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = decode_messages(message_log(spark, sf_dir))
    return users.select("id", "registered_date", is_uuid(F.col("id")).alias("storable"))


def undecodable_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected(screen_messages(message_log(spark, sf_dir))).select(
        "partition", "offset", "reason", F.col("value").cast("string").alias("value")
    )


# --- streaming half -------------------------------------------------------------------


def _ingest(
    spark: SparkSession,
    source: str,
    log: str,
    checkpoint: str | None = None,
    max_files: int | None = None,
) -> None:
    checkpoint = checkpoint or shared_folder(spark, "checkpoint")
    messages = read_message_files(spark, source, TOPIC, file_caps(max_files))
    drain_messages(messages, batch_writer(log, checkpoint), checkpoint)


def _records(log: DataFrame) -> DataFrame:
    return storable(log).select(*USER_COLUMNS)


def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = shared_folder(spark, "log")
    _ingest(spark, message_files(spark, sf_dir), log)
    return _records(read_log(spark, log))


def stream_rate_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files per micro-batch, from three drops of two files each: rows and rejects of every batch."""
    source, log = shared_folder(spark, "messages"), shared_folder(spark, "log")
    messages = message_log(spark, sf_dir)
    for drop in range(3):
        messages.filter(F.col("offset") % 3 == drop).repartition(2).write.mode("append").parquet(source)
    _ingest(spark, source, log, max_files=2)
    return read_log(spark, log).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("messages"), F.count("reason").alias("rejects")
    )


#: Streams side by side where one would run batch after batch.
_LANES = 8


def stream_record_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of at most 3,000 messages, from files that are landed with as many: how many batches have which size.

    The files of a topic partition are dealt to lanes, and each lane is a stream with a checkpoint of its own.
    """
    log, cap = shared_folder(spark, "log"), 3000
    source, lanes = laned_files(spark, sf_dir, TOPIC, cap, _LANES)
    caps, streams = record_caps(spark, source, cap, cap), []
    for lane in range(lanes):
        checkpoint = shared_folder(spark, "checkpoint")
        stream = read_message_files(spark, f"{source}/lane={lane}", TOPIC, caps)
        streams.append((stream, batch_writer(log, checkpoint), checkpoint))
    drain_together(streams)
    sizes = read_log(spark, log).groupBy("run", "batch_id").agg(F.count(F.lit(1)).alias("messages"))
    return sizes.groupBy("messages").agg(F.count(F.lit(1)).alias("batches"))


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a listener is told of three batches while the stream runs: messages and rejects of each."""
    source, log = shared_folder(spark, "messages"), shared_folder(spark, "log")
    messages, told = message_log(spark, sf_dir), []
    for drop in range(3):
        messages.filter(F.col("offset") % 3 == drop).coalesce(1).write.mode("append").parquet(source)
    with progress_told(spark, told.append):
        _ingest(spark, source, log, max_files=1)
        end = time.monotonic() + 60  # the last events follow the end of the query
        while not any(x.get("ended") for x in told) and time.monotonic() < end:
            time.sleep(0.05)
    rows = [(x["batch_id"], x["ingest.messages"], x["ingest.rejects"]) for x in told if "batch_id" in x]
    return spark.createDataFrame(rows, "batch_id long, messages long, rejects long")


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stopped when a half has come, and started again on the same checkpoint: nothing is read twice or lost."""
    source, log = shared_folder(spark, "messages"), shared_folder(spark, "log")
    checkpoint = shared_folder(spark, "checkpoint")
    for half in range(2):
        rows = message_log(spark, sf_dir).filter(F.col("offset") % 2 == half)
        rows.write.mode("append").parquet(source)
        _ingest(spark, source, log, checkpoint)
    return _records(read_log(spark, log))


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = shared_folder(spark, "log")
    _ingest(spark, message_files(spark, sf_dir), log)
    rejects = rejected_messages(read_log(spark, log))
    return rejects.select(
        "partition", "offset", "reason", F.col("value").cast("string").alias("value")
    )


def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = shared_folder(spark, "log")
    _ingest(spark, message_files(spark, sf_dir), log)
    return current_users(read_log(spark, log))


def replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole source ingested twice, the second time on a fresh checkpoint."""
    source, log = message_files(spark, sf_dir), shared_folder(spark, "log")
    for _ in range(2):
        _ingest(spark, source, log)
    return current_users(read_log(spark, log))


def two_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams with equal settings, each with half of the messages and a checkpoint of its own, fill one log."""
    log = shared_folder(spark, "log")
    for half in range(2):
        source = shared_folder(spark, "messages")
        message_log(spark, sf_dir).filter(F.col("offset") % 2 == half).write.parquet(source)
        _ingest(spark, source, log)
    return _records(read_log(spark, log))


def store_and_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream with a store beside the log, for which Parquet stands in: both hold the current users."""
    store, log = shared_folder(spark, "store"), shared_folder(spark, "log")
    checkpoint = shared_folder(spark, "checkpoint")
    messages = read_message_files(spark, message_files(spark, sf_dir))
    write = store_writer(batch_writer(log, checkpoint), {"path": store}, "parquet")
    drain_messages(messages, write, checkpoint)
    stored = spark.read.parquet(store).withColumn("held_by", F.lit("store"))
    logged = current_users(read_log(spark, log)).withColumn("held_by", F.lit("log"))
    return stored.unionByName(logged)


def compacted_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams compacted into a new log, to which a third then adds the same messages."""
    source = message_files(spark, sf_dir)
    log, target = shared_folder(spark, "log"), shared_folder(spark, "compacted")
    for _ in range(2):
        _ingest(spark, source, log)
    compact_log(spark, log, target)
    _ingest(spark, source, target)
    return current_users(read_log(spark, target))


def _new_table(spark: SparkSession) -> UserTable:
    folder = shared_folder(spark, "table")
    name = f"users_{folder.rsplit('-', 1)[1]}"
    return UserTable(folder, shared_folder(spark, "log"), "rollbook_check", name, buckets=8)


def _taken(spark: SparkSession, table: UserTable) -> DataFrame:
    """The rows of a table that is made for a check, which leaves no name in the catalog."""
    path = shared_folder(spark, "rows")
    spark.table(table.name).write.parquet(path)
    drop_table(spark, table)
    return spark.read.parquet(path)


def stored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table is made twice, merged twice with the log in between, and read by name."""
    table = _new_table(spark)
    source = message_files(spark, sf_dir)
    for buckets in (None, 5):
        ensure_table(spark, table)
        _ingest(spark, source, table.log_path)
        merge_log(spark, table, buckets)
    return _taken(spark, table)


def live_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table is made before the first batch and read after the last, merged in between."""
    table, source = _new_table(spark), shared_folder(spark, "messages")
    checkpoint = shared_folder(spark, "checkpoint")
    ensure_table(spark, table)
    for half in range(2):
        rows = message_log(spark, sf_dir).filter(F.col("offset") % 2 == half)
        rows.write.mode("append").parquet(source)
        _ingest(spark, source, table.log_path, checkpoint)
        if not half:
            merge_log(spark, table)
    return _taken(spark, table)


def random_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, version and number of random ids, over all events."""
    ids = spark.read.parquet(f"{sf_dir}/events.parquet").select(random_id().alias("id"))
    version = r"^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    return ids.agg(
        F.count_if(is_uuid(F.col("id"))).alias("storable"),
        F.count_if(F.col("id").rlike(version)).alias("random"),
        F.count_distinct("id").alias("distinct_ids"),
    )


class _Producer:
    """A landing zone with its scheduled runs."""

    def __init__(self, spark: SparkSession, **settings):
        self.spark, self.settings = spark, settings
        self.landing, self.published = shared_folder(spark, "landing"), shared_folder(spark, "published")
        self.staging, self.checkpoint = shared_folder(spark, "staging"), shared_folder(spark, "checkpoint")

    def land(self, responses: DataFrame) -> None:
        """In files of the size that adaptive execution aims at, however many tasks make the responses."""
        responses.hint("rebalance").write.mode("append").parquet(self.landing)

    def run(self, publish=None) -> None:
        drain_responses(
            read_responses(self.spark, self.landing, streaming=True, caps=file_caps(4)),
            publish or self.publish,
            self.staging,
            self.checkpoint,
            **self.settings,
        )

    def publish(self, messages: DataFrame) -> None:
        publish_files(messages, self.published)

    def messages(self) -> DataFrame:
        return decode_messages(read_message_files(self.spark, self.published, streaming=False))

    def progress(self) -> DataFrame:
        return Staging(self.spark, self.staging).progress()


def quota_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three drops, three runs with the usual quota, the second of which fails once after it has published.

    Which request goes out in which run; those without a run remain for later ones.
    """
    job, responses = _Producer(spark, keyed=True), landed_responses(spark, sf_dir)

    def fails(messages: DataFrame) -> None:
        job.publish(messages)
        raise ConnectionError("lost after publishing")

    for drop in range(3):
        job.land(responses.filter(F.col("request_id") % 3 == drop))
        if drop == 1:
            with contextlib.suppress(ConnectionError):
                job.run(fails)
        job.run()
    return job.progress().filter(F.col("outcome") == ACCEPTED).select("request_id", "id", "run")


def split_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts of a request land in up to three drops, those of the first drop again in the later ones."""
    job, responses = _Producer(spark, quota=None, keyed=True), landed_responses(spark, sf_dir)
    drop = F.least(F.floor((F.col("attempt") - 1) / 2), F.lit(2))
    for number in range(3):
        job.land(responses.filter((drop == number) | (drop == 0)))
        job.run()
    return job.progress().drop("run")


def producer_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random ids, a run that fails after publishing, and its restart: how many ids a user has been sent under."""
    job = _Producer(spark, quota=None)
    job.land(landed_responses(spark, sf_dir))

    def fails(messages: DataFrame) -> None:
        job.publish(messages)
        raise ConnectionError("lost after publishing")

    with contextlib.suppress(ConnectionError):
        job.run(fails)
    job.run()
    return job.messages().groupBy("phone").agg(F.count_distinct("id").alias("ids"))


def scheduled_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of responses, each followed by a run that takes only what is new."""
    job, responses = _Producer(spark, quota=None, keyed=True), landed_responses(spark, sf_dir)
    for drop in range(2):
        job.land(responses.filter(F.col("request_id") % 2 == drop))
        job.run()
    return job.messages()


def end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses to published messages to ingested current users, through files on every side."""
    published, log = shared_folder(spark, "published"), shared_folder(spark, "log")
    produce(
        landed_responses(spark, sf_dir),
        lambda messages: publish_files(messages, published),
        shared_folder(spark, "staging"),
        quota=None,
        keyed=True,
    )
    _ingest(spark, published, log)
    return current_users(read_log(spark, log))


QUERIES: dict[str, Query] = {
    "raw_valid": raw_valid,
    "first_result": first_result,
    "first_valid_attempt": first_attempt,
    "exhausted_requests": exhausted,
    "format_user_record": format_user_record,
    "format_rejects": format_rejects,
    "request_outcomes": request_outcomes,
    "deterministic_id": deterministic_id,
    "quota_limit": quota_limit,
    "publish_count": publish_count,
    "wire_encode": wire_encode,
    "topic_subscribe": topic_subscribe,
    "value_cast": value_cast,
    "wire_decode": wire_decode,
    "uuid_valid": uuid_valid,
    "undecodable_rejects": undecodable_rejects,
    "ensure_table": stored_table,
    "stream_append": stream_append,
    "stream_rate_limited": stream_rate_limited,
    "stream_record_limited": stream_record_limited,
    "stream_progress": stream_progress,
    "stream_resume": stream_resume,
    "stream_rejects": stream_rejects,
    "keyed_upsert": keyed_upsert,
    "replay_idempotent": replay_idempotent,
    "live_view": live_view,
    "two_checkpoints": two_checkpoints,
    "store_and_log": store_and_log,
    "random_id": random_ids,
    "quota_runs": quota_runs,
    "split_attempts": split_attempts,
    "producer_replay": producer_replay,
    "compacted_log": compacted_log,
    "scheduled_runs": scheduled_runs,
    "end_to_end": end_to_end,
}
