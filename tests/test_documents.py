"""Which response bodies count as valid, and what their first element is."""

import pytest
from pyspark.sql import functions as F

from rollbook.functions.documents import results
from rollbook.operators.attempts import valid_attempts
from rollbook.schema import RESPONSE_SCHEMA

BODIES = [
    ('{"results":[{"gender":"f","name":null},{"gender":"m"}]}', 2, '{"gender":"f","name":null}'),
    ('{"results":["x"]}', 1, '"x"'),
    ('{"results":[]}', 0, None),
    ('{"results":"s"}', None, None),
    ('{"results":{"a":1}}', None, None),
    ('{"results":null}', None, None),
    ('{"error":"e"}', None, None),
    ("[1]", None, None),
    ('[{"results":[{"a":1}]}]', None, None),
    ("nope", None, None),
    ("", None, None),
    (None, None, None),
    (' {"results":[{"a":1}]} \n', 1, '{"a":1}'),
    # Text after the document, broken text inside it, and other spellings of JSON are refused.
    ('{"results":[{"a":1}]} xx', None, None),
    ('{"results":[{"a":1}]}{"b":2}', None, None),
    ('{"results":[{"a":1}],"info":nope}', None, None),
    ('{"results":[{"a":007}]}', None, None),
    ("{'results':[{'a':1}]}", None, None),
    # A repeated key takes its last value.
    ('{"results":[{"a":1}],"results":[{"a":2}]}', 1, '{"a":2}'),
    ('{"results":[{"a":1,"a":2}]}', 1, '{"a":2}'),
]


def responses(spark, rows):
    return spark.createDataFrame(rows, RESPONSE_SCHEMA)


def test_results_of_a_body(spark):
    frame = responses(spark, [(i, 1, 200, body) for i, (body, _, _) in enumerate(BODIES)])
    found = frame.select("request_id", F.size(results(F.col("body"))).alias("n")).collect()
    assert {row.request_id: row.n for row in found} == {
        i: n for i, (_, n, _) in enumerate(BODIES)
    }


def test_valid_attempts_take_the_first_element(spark):
    frame = responses(spark, [(i, 1, 200, body) for i, (body, _, _) in enumerate(BODIES)])
    valid = valid_attempts(frame).select("request_id", F.to_json("user").alias("user")).collect()
    assert {row.request_id: row.user for row in valid} == {
        i: first for i, (_, n, first) in enumerate(BODIES) if n
    }


@pytest.mark.parametrize("status", [500, 404, 201, None])
def test_other_statuses_are_not_valid(spark, status):
    frame = responses(spark, [(1, 1, status, '{"results":[{"a":1}]}')])
    assert valid_attempts(frame).count() == 0
