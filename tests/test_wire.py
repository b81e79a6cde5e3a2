"""Encoding and decoding of messages."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from rollbook.fixed import TOPIC, USER_COLUMNS
from rollbook.operators.screening import rejected, screen_messages, storable
from rollbook.operators.wire import decode_messages, encode_messages, message_text
from rollbook.schema import MESSAGE_SCHEMA, USER_SCHEMA

SHORT = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("id", "postcode", "email")]
)
NULLS = (None, None, None)

DECODES = [
    ('{"id":"a","postcode":"1","email":"e"}', ("a", "1", "e")),
    ('{"id":"a","postcode":12345,"email":"e"}', ("a", "12345", "e")),
    ('{"id":"a","postcode":1.50,"email":1e3}', ("a", "1.5", "1000.0")),
    ('{"id":true,"postcode":null,"email":"e"}', ("true", None, "e")),
    ('{"id":{"x": 1},"postcode":[1, 2],"email":"e"}', ('{"x":1}', "[1,2]", "e")),
    ('{"id":"a"}', ("a", None, None)),
    ('{"id":"a","zzz":1}', ("a", None, None)),
    ('{"ID":"a"}', NULLS),
    ('{"id":"a","id":"b"}', ("b", None, None)),
    ('{"id":"a","postcode":"1"', NULLS),
    ("not json", NULLS),
    ("", NULLS),
    ("   ", NULLS),
    (None, NULLS),
    ('[{"id":"a"}]', NULLS),
    ('[{"id":"a"},{"id":"b"}]', NULLS),
    ("5", NULLS),
    ("null", NULLS),
    ('{"id":"Jos\\u00e9"}', ("José", None, None)),
    ('{"id":"a"} xx', ("a", None, None)),
    ("{'id':'a'}", ("a", None, None)),
    ('{"id":"a","postcode":007}', NULLS),
]


def messages(spark, texts):
    rows = [
        (None, None if text is None else bytearray(text.encode()), TOPIC, 0, n, None, 0)
        for n, text in enumerate(texts)
    ]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1)


@pytest.mark.parametrize(("text", "expected"), DECODES, ids=[repr(t)[:40] for t, _ in DECODES])
def test_decode(spark, text, expected):
    rows = decode_messages(messages(spark, [text]), SHORT).collect()
    assert [tuple(row) for row in rows] == [expected]


def test_decode_keeps_every_message_and_names_all_columns(spark):
    decoded = decode_messages(messages(spark, [text for text, _ in DECODES]))
    assert decoded.count() == len(DECODES)
    assert tuple(decoded.columns) == USER_COLUMNS


def test_bytes_to_text(spark):
    rows = message_text(messages(spark, ["naïve 张", None])).collect()
    assert [row.value for row in rows] == ["naïve 张", None]


def test_encoded_message_writes_nulls(spark):
    record = dict.fromkeys(USER_COLUMNS) | {"id": "a", "full_name": 'José "J" \\ 张\n'}
    users = spark.createDataFrame([record], USER_SCHEMA)
    message = encode_messages(users).first()
    assert message.topic == TOPIC
    assert json.loads(message.value.decode("utf-8")) == record


def test_older_readers_escaped_text_decodes_the_same(spark):
    record = dict.fromkeys(USER_COLUMNS, "José 张 \U0001f600")
    texts = [json.dumps(record), json.dumps(record, ensure_ascii=False)]
    rows = decode_messages(messages(spark, texts)).collect()
    assert [row.asDict() for row in rows] == [record, record]


_text = st.none() | st.text(st.characters(exclude_categories=["Cs"]), max_size=12)


@settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(st.lists(st.tuples(*[_text] * len(USER_COLUMNS)), min_size=1, max_size=40))
def test_round_trip(spark, records):
    users = spark.createDataFrame(records, USER_SCHEMA).coalesce(1)
    rows = decode_messages(encode_messages(users)).collect()
    assert [tuple(row) for row in rows] == records


GOOD = "b6cfa0c0-1234-4abc-8def-0123456789ab"
SCREENED = [
    (json.dumps({"id": GOOD}), None),
    (json.dumps({"id": GOOD.upper()}), None),
    (json.dumps({"id": GOOD, "_corrupt_record": "only a field name"}), None),
    ("", "empty message"),
    ("  ", "empty message"),
    (None, "empty message"),
    ("not json", "malformed JSON"),
    ('{"id":"' + GOOD + '","email":"cut', "malformed JSON"),
    ('[{"id":"' + GOOD + '"}]', "malformed JSON"),
    ("null", "malformed JSON"),
    ("5", "malformed JSON"),
    ("{}", "missing id"),
    ('{"id":null}', "missing id"),
    (json.dumps({"ID": GOOD}), "missing id"),
    ('{"id":"x"}', "id is not a UUID"),
    ('{"id":""}', "id is not a UUID"),
    ('{"id":7}', "id is not a UUID"),
]


def test_screening(spark):
    screened = screen_messages(messages(spark, [text for text, _ in SCREENED]))
    rows = {row.offset: row for row in screened.collect()}
    assert {n: row.reason for n, row in rows.items()} == {
        n: reason for n, (_, reason) in enumerate(SCREENED)
    }
    for n, (text, reason) in enumerate(SCREENED):
        kept = rows[n].value if rows[n].value is None else rows[n].value.decode()
        assert kept == (text if reason else None)
    assert {row.id for row in storable(screened).collect()} == {GOOD}
    assert rejected(screened).count() == len(SCREENED) - 3


def test_screening_parses_each_message_once(spark, plan):
    screened = screen_messages(messages(spark, ["{}"]))
    for frame in (screened, storable(screened), rejected(screened)):
        assert plan(frame).count("from_json") == 1


def test_bytes_that_are_no_text_do_not_stop_the_stream(spark):
    good = b'{"id":"' + GOOD.encode() + b'","full_name":"a\xff\xfeb"}'
    values = [good, b"\xff\xfe", b"\x00", b'{"id":"\xff"}']
    rows = [(None, bytearray(v), TOPIC, 0, n, None, 0) for n, v in enumerate(values)]
    screened = screen_messages(spark.createDataFrame(rows, MESSAGE_SCHEMA))
    assert [row.offset for row in storable(screened).collect()] == [0]
    kept = {row.offset: bytes(row.value) for row in rejected(screened).collect()}
    assert kept == dict(enumerate(values[1:], 1))
