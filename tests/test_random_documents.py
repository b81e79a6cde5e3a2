"""Random documents and messages, flattened and decoded by Spark and by DuckDB's JSON functions."""

import json
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from rollbook.fixed import CONTAINERS, USER_COLUMNS
from rollbook.functions.identifiers import keyed_id
from rollbook.operators.flatten import flatten
from rollbook.operators.wire import decode_messages
from rollbook.plans.oracles import _DECODED, _REASON, _RECORD_OF_USER

LEAVES = [
    "name.first",
    "name.last",
    "gender",
    "location.street.number",
    "location.street.name",
    "location.city",
    "location.state",
    "location.country",
    "location.postcode",
    "email",
    "login.username",
    "dob.date",
    "registered.date",
    "phone",
    "picture.medium",
]
TEXTS = ["", " ", "x", "None", "null", "José 张", 'say "hi"', "a\\b", "line\nline", "{}", "007"]


def put(document, path, value):
    *parents, last = path.split(".")
    for name in parents:
        document = document.setdefault(name, {})
        if not isinstance(document, dict):
            return
    document[last] = value


def random_user(rng):
    user = {}
    for path in CONTAINERS:
        if rng.random() < 0.02:
            put(user, path, rng.choice([None, "text", 5, [], [{"a": 1}], True]))
        elif rng.random() < 0.5:
            put(user, path, {})
    for path in rng.sample(LEAVES, rng.randint(5, len(LEAVES))):
        kind = rng.random()
        if kind < 0.15:
            put(user, path, None)
        elif kind < 0.35:
            put(user, path, rng.choice([0, 7, -12, 10**12, 12345678901234567890]))
        else:
            put(user, path, rng.choice(TEXTS))
    if rng.random() < 0.3:
        user["extra"] = {"name": {"first": "not this one"}}
    return user


@pytest.fixture(scope="module")
def parquet(spark, tmp_path_factory):
    """Documents and messages as files that both engines read."""
    rng = random.Random(11)
    folder = tmp_path_factory.mktemp("random")
    users = [json.dumps(random_user(rng), ensure_ascii=rng.random() < 0.5) for _ in range(4000)]
    users += ["null", "5", '"x"', "[]", "{}"]
    records = []
    for _ in range(4000):
        names = rng.sample(USER_COLUMNS, rng.randint(0, len(USER_COLUMNS)))
        record = {name: rng.choice([None, 3, *TEXTS]) for name in names}
        records.append(json.dumps(record | ({"other": 1} if rng.random() < 0.2 else {})))
    for name, texts in (("users", users), ("records", records)):
        frame = spark.createDataFrame(list(enumerate(texts)), "request_id long, text string")
        frame.write.parquet(str(folder / name))
    return folder


def rows(relation):
    return sorted(map(repr, relation))


def test_flattening(spark, parquet):
    documents = spark.read.parquet(str(parquet / "users"))
    flat = flatten(documents.select("request_id", F.parse_json("text").alias("user")))
    kept = flat.select("request_id", "reason", keyed_id(F.col("request_id")), *USER_COLUMNS[1:])
    found = [tuple(row) if row.reason is None else tuple(row)[:2] for row in kept.collect()]
    expected = duckdb.sql(
        f"""
        SELECT request_id, {_REASON} AS reason, {_RECORD_OF_USER}
        FROM (SELECT request_id, CAST(text AS JSON) AS u FROM '{parquet}/users/*.parquet')
        """
    ).fetchall()
    expected = [row if row[1] is None else row[:2] for row in expected]
    assert rows(found) == rows(expected)
    assert {len(row) for row in found} == {2, len(USER_COLUMNS) + 2}


def test_decoding(spark, parquet):
    messages = spark.read.parquet(str(parquet / "records"))
    decoded = decode_messages(messages.select(F.col("text").cast("binary").alias("value")))
    expected = duckdb.sql(f"SELECT {_DECODED} FROM '{parquet}/records/*.parquet'").fetchall()
    assert rows(tuple(row) for row in decoded.collect()) == rows(expected)
