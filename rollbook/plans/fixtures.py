"""Inputs of the registered queries, derived from the `customer` and `events` tables.

The expressions are SQL text because the check queries build the same rows with
them. The remainders choose which shape a row takes; every row of the table is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rollbook.fixed import USER_COLUMNS
from rollbook.functions.identifiers import keyed_id
from rollbook.operators.ranking import numbered
from rollbook.operators.wire import record_json
from rollbook.schema import MESSAGE_SCHEMA
from rollbook.session import shared_folder
from rollbook.sinks.messages import file_size

# --- landed responses, one request per customer -------------------------------

# Attempts landed per request. Some fail once, twice, or all five times and answer on the sixth; some
# have failed three times and wait.
ATTEMPTS = """
    CASE WHEN c_custkey % 20 = 3 THEN 3
         ELSE CASE c_custkey % 10 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 6 ELSE 1 END END
"""
STATUS = "CASE WHEN c_custkey % 10 = 0 AND attempt = 1 THEN 500 ELSE 200 END"

_KEY = "CAST(c_custkey AS STRING)"
_MONTH_DAY = "lpad(CAST(c_custkey % 12 + 1 AS STRING), 2, '0') || '-01T00:00:00.000Z'"
# Each container is something else than an object in some document.
_STREET = f"""
    CASE WHEN c_custkey % 47 = 0 THEN '[]'
         ELSE '{{"name":"' || c_mktsegment || '","number":' || {_KEY} || '}}' END
"""
_LOCATION = f"""
    CASE WHEN c_custkey % 17 = 0 THEN 'null' ELSE
        '{{"city":"City' || CAST(c_nationkey AS STRING)
        || '","country":"Country' || CAST(c_nationkey AS STRING)
        || '","postcode":'
        || CASE WHEN c_custkey % 11 = 0 THEN 'null' WHEN c_custkey % 29 = 0 THEN '0.0001'
                WHEN c_custkey % 31 = 0 THEN '1234567890123456.5' WHEN c_custkey % 37 = 0 THEN 'true'
                WHEN c_custkey % 5 = 0 THEN CAST(10000 + c_custkey AS STRING) || '.25'
                ELSE CAST(10000 + c_custkey AS STRING) END
        || CASE WHEN c_custkey % 7 = 0 THEN ''
                ELSE ',"state":"State' || CAST(c_custkey % 50 AS STRING) || '"' END
        || CASE WHEN c_custkey % 79 = 0 THEN '}}' ELSE ',"street":' || {_STREET} || '}}' END
    END
"""
_OBJECT = f"""
    '{{"dob":' || CASE WHEN c_custkey % 61 = 0 THEN 'null' ELSE '{{"date":"1980-' || {_MONTH_DAY} || '"}}' END
    || ',"email":'
    || CASE WHEN c_custkey % 13 = 0 THEN 'null'
            ELSE '"' || lower(c_name) || '@example.com"' END
    || CASE WHEN c_custkey % 19 = 0 THEN ''
            WHEN c_custkey % 2 = 0 THEN ',"gender":"female"' ELSE ',"gender":"male"' END
    || ',"location":' || {_LOCATION}
    || CASE WHEN c_custkey % 23 = 0 THEN '' WHEN c_custkey % 59 = 0 THEN ',"login":1'
            ELSE ',"login":{{"username":"user' || {_KEY} || '"}}' END
    || CASE WHEN c_custkey % 73 = 0 THEN '' WHEN c_custkey % 53 = 0 THEN ',"name":"text"'
            ELSE ',"name":{{"first":"' || split_part(c_name, '#', 1)
                 || '","last":"' || split_part(c_name, '#', 2) || '"}}' END
    || ',"phone":"555-' || {_KEY}
    || '","picture":' || CASE WHEN c_custkey % 71 = 0 THEN 'false'
                              ELSE '{{"medium":"https://example.com/med/' || {_KEY} || '.jpg"}}' END
    || ',"registered":' || CASE WHEN c_custkey % 67 = 0 THEN '"text"'
                                ELSE '{{"date":"2010-' || {_MONTH_DAY} || '"}}' END || '}}'
"""
_USER = f"""
    CASE WHEN c_custkey % 41 = 0 THEN '"text"' WHEN c_custkey % 43 = 0 THEN 'null' ELSE {_OBJECT} END
"""
BODY = f"""
    CASE WHEN c_custkey % 10 = 0 AND attempt = 1 THEN NULL
         WHEN c_custkey % 20 = 3 THEN '{{"results":{{}}}}'
         WHEN c_custkey % 10 = 1 AND attempt <= 2 THEN '{{"results":[]}}'
         WHEN c_custkey % 10 = 2 AND attempt <= 5 AND attempt % 2 = 1 THEN '{{"error":"e"}}'
         WHEN c_custkey % 10 = 2 AND attempt <= 5 THEN 'nope'
         ELSE '{{"results":[' || {_USER}
              || CASE WHEN c_custkey % 3 = 0 THEN ',{{"gender":"second"}}' ELSE '' END || ']}}'
    END
"""


def landed_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    # A compact table may be a single split; what is made of it is large.
    customers = customers.repartition(spark.sparkContext.defaultParallelism)
    attempts = customers.withColumn("attempt", F.explode(F.expr(f"sequence(1, {ATTEMPTS})")))
    return attempts.select(
        F.col("c_custkey").alias("request_id"),
        "attempt",
        F.expr(STATUS).alias("status"),
        F.expr(BODY).alias("body"),
    )


# --- messages, one per event; a user's events share one id ---------------------

# Columns of the record in the message, except the id.
RECORD = {
    "full_name": "'User ' || CAST(user_id AS STRING)",
    "gender": "event_type",
    "address": "props",
    "postcode": "CAST(value AS STRING)",
    "email": "'user' || CAST(user_id AS STRING) || '@example.com'",
    "user_name": "'user' || CAST(user_id AS STRING)",
    "dob": "CAST(event_id % 3 AS STRING)",
    "registered_date": "CAST(event_id AS STRING)",
    "phone": "CASE WHEN event_id % 9 = 0 THEN NULL ELSE '555-' || CAST(event_id AS STRING) END",
    "image": "'https://example.com/' || CAST(event_id AS STRING) || '.jpg'",
}
# The id as sent: most are good, one kind is no UUID, one is in upper case, one is absent.
SENT_ID = """
    CASE event_id % 50 WHEN 8 THEN 'x' WHEN 10 THEN upper(id) WHEN 11 THEN NULL ELSE id END
"""
# The message text as sent: one kind is no JSON, one is empty.
SENT_TEXT = """
    CASE event_id % 50 WHEN 7 THEN 'not json' WHEN 9 THEN NULL ELSE json END
"""
TOPIC_OF = "CASE WHEN event_id % 20 = 0 THEN 'other_topic' ELSE 'users_created' END"


def _records(events: DataFrame, *further: str) -> DataFrame:
    return events.select(
        "event_id",
        "ts",
        *further,
        keyed_id(F.col("user_id")).alias("id"),
        *[F.expr(text).alias(name) for name, text in RECORD.items()],
    )


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eleven-column records, all with good ids, plus `event_id` and `ts`."""
    return _records(spark.read.parquet(f"{sf_dir}/events.parquet"))


def _positioned(events: DataFrame) -> DataFrame:
    """Events with topic, partition and offset of their messages."""
    columns = {"topic": TOPIC_OF, "partition": "event_id % 3", "offset": "event_id div 3"}
    return events.withColumns(
        {name: F.expr(text).cast(MESSAGE_SCHEMA[name].dataType) for name, text in columns.items()}
    )


def _messages(events: DataFrame, *further: str) -> DataFrame:
    """Positioned events in the Kafka envelope, with `further` columns of theirs."""
    kept = ("topic", "partition", "offset", *further)
    sent = _records(events, *kept).withColumn("id", F.expr(SENT_ID))
    sent = sent.select("event_id", "ts", *kept, record_json(*USER_COLUMNS).alias("json"))
    columns = {"key": F.lit(None), "value": F.expr(SENT_TEXT), "timestamp": F.col("ts"), "timestampType": F.lit(0)}
    envelope = [
        columns[f.name].cast(f.dataType).alias(f.name) if f.name in columns else F.col(f.name)
        for f in MESSAGE_SCHEMA.fields
    ]
    return sent.select(*envelope, *further)


def message_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records as messages in the Kafka envelope, bad ones included."""
    return _messages(_positioned(spark.read.parquet(f"{sf_dir}/events.parquet")))


def laned_files(spark: SparkSession, sf_dir: str, topic: str, cap: int, lanes: int) -> tuple[str, int]:
    """The messages of a topic written as files of `cap`, each topic partition's in the order of offsets and its last
    file smaller, dealt to as many folders as there are lanes; returns the path and how many lanes have files.

    The events are numbered and dealt out, and become messages, which are much larger, in the task that writes them.
    """
    path = shared_folder(spark, "messages")
    events = _positioned(spark.read.parquet(f"{sf_dir}/events.parquet")).filter(F.col("topic") == topic)
    dealt = numbered(events, "place", "partition", "offset").withColumn("file", F.expr(f"place div {cap}"))
    dealt, seen = dealt.withColumn("lane", F.col("file") % lanes), Observation("lanes")
    # Of one lane and partition a task writes file after file, all full but the last, as the order of places has them.
    dealt = dealt.observe(seen, F.max("lane").alias("last")).repartition("partition", "file")
    messages = _messages(dealt.sortWithinPartitions("lane", "partition", "place"), "lane")
    messages.write.options(**file_size(cap)).partitionBy("lane", "partition").parquet(path)
    last = seen.get["last"]
    return path, 0 if last is None else last + 1


def message_files(spark: SparkSession, sf_dir: str) -> str:
    """The message log written as files, one directory per topic partition; returns the path."""
    path = shared_folder(spark, "messages")
    message_log(spark, sf_dir).write.partitionBy("partition").parquet(path)
    return path
