import uuid

import pytest
from pyspark.sql import functions as F

from rollbook.functions.identifiers import canonical_id, is_uuid, keyed_id, random_id

GOOD = "b6cfa0c0-1234-4abc-8def-0123456789ab"


@pytest.mark.parametrize(
    ("text", "accepted"),
    [
        (GOOD, True),
        (GOOD.upper(), True),
        ("x", False),
        ("", False),
        (None, False),
        (GOOD[:-1], False),
        (GOOD + "0", False),
        (GOOD + "\n", False),
        ("\n" + GOOD, False),
        (GOOD.replace("-", ""), False),
        ("g" + GOOD[1:], False),
        ("{" + GOOD + "}", False),
    ],
)
def test_form(spark, text, accepted):
    frame = spark.createDataFrame([(text,)], "id string")
    assert frame.select(is_uuid(F.col("id"))).first()[0] is accepted


def test_both_cases_are_one_key(spark):
    frame = spark.createDataFrame([(GOOD,), (GOOD.upper(),)], "id string")
    assert {row[0] for row in frame.select(canonical_id(F.col("id"))).collect()} == {GOOD}


def test_keyed_ids_are_repeatable_distinct_uuids(spark):
    ids = [row.id for row in spark.range(1000).select(keyed_id(F.col("id")).alias("id")).collect()]
    again = spark.range(1000).repartition(7).select("id", keyed_id(F.col("id")).alias("key"))
    assert len(set(ids)) == 1000
    assert {row.id: row.key for row in again.collect()} == dict(enumerate(ids))
    parsed = [uuid.UUID(text) for text in ids]
    assert all(str(value) == text for value, text in zip(parsed, ids, strict=True))
    assert {value.version for value in parsed} == {3}
    assert {value.variant for value in parsed} == {uuid.RFC_4122}


def test_random_ids_are_new_v4_uuids(spark):
    def draw():
        return [row.id for row in spark.range(50).select(random_id().alias("id")).collect()]

    first, second = draw(), draw()
    assert len({*first, *second}) == 100
    assert {uuid.UUID(text).version for text in first} == {4}
