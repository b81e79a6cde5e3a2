"""Flattening rules: missing, null, and wrongly typed parts of a raw user."""

import json
import random

import pytest
from pyspark.sql import functions as F

from rollbook.fixed import CONTAINERS, USER_COLUMNS
from rollbook.functions.documents import printed
from rollbook.operators.flatten import flatten_rejects, flatten_users

EMPTY = {name: "" for name in USER_COLUMNS if name != "id"}
EMPTY |= {"full_name": " ", "address": " , , , "}

FULL = {
    "name": {"first": "Ann", "last": "Lee", "title": "Ms"},
    "gender": "female",
    "location": {
        "street": {"number": 93, "name": "Main St"},
        "city": "Oslo",
        "state": "Viken",
        "country": "Norway",
        "postcode": 1234,
        "coordinates": {"latitude": "1"},
    },
    "email": "ann@example.com",
    "login": {"username": "ann", "uuid": "ignored"},
    "dob": {"date": "1990-01-02T03:04:05.678Z", "age": 33},
    "registered": {"date": "2010-01-02T03:04:05.678Z"},
    "phone": "555",
    "picture": {"medium": "m.jpg", "large": "l.jpg"},
    "nat": "NO",
}
FULL_RECORD = {
    "full_name": "Ann Lee",
    "gender": "female",
    "address": "93 Main St, Oslo, Viken, Norway",
    "postcode": "1234",
    "email": "ann@example.com",
    "user_name": "ann",
    "dob": "1990-01-02T03:04:05.678Z",
    "registered_date": "2010-01-02T03:04:05.678Z",
    "phone": "555",
    "image": "m.jpg",
}

CASES = [
    ("{}", {}),
    ('{"gender":null}', {"gender": None}),
    ('{"email":null}', {"email": None}),
    ('{"phone":null}', {"phone": None}),
    ('{"login":{"username":null}}', {"user_name": None}),
    ('{"dob":{"date":null}}', {"dob": None}),
    ('{"registered":{"date":null}}', {"registered_date": None}),
    ('{"picture":{"medium":null}}', {"image": None}),
    ('{"login":{}}', {}),
    ('{"name":{"first":null}}', {"full_name": "None "}),
    ('{"name":{"last":"Lee"}}', {"full_name": " Lee"}),
    ('{"name":{"first":"Jos\\u00e9","last":"\\u5f20"}}', {"full_name": "José 张"}),
    ('{"location":{"city":"Oslo"}}', {"address": " , Oslo, , "}),
    ('{"location":{"city":null}}', {"address": " , None, , "}),
    ('{"location":{"street":{"number":7}}}', {"address": "7 , , , "}),
    ('{"location":{"street":{"number":null,"name":"A"}}}', {"address": "None A, , , "}),
    ('{"location":{"postcode":null}}', {"postcode": "None"}),
    ('{"location":{"postcode":"AB1"}}', {"postcode": "AB1"}),
    ('{"location":{"postcode":93}}', {"postcode": "93"}),
    ('{"location":{"postcode":-5}}', {"postcode": "-5"}),
    ('{"location":{"postcode":1.50}}', {"postcode": "1.5"}),
    ('{"location":{"postcode":100.00}}', {"postcode": "100.0"}),
    ('{"location":{"postcode":0.25}}', {"postcode": "0.25"}),
    ('{"location":{"postcode":1e3}}', {"postcode": "1000.0"}),
    ('{"location":{"postcode":1e16}}', {"postcode": "1e+16"}),
    ('{"location":{"postcode":0.00001}}', {"postcode": "1e-05"}),
    ('{"location":{"postcode":-1.5e-7}}', {"postcode": "-1.5e-07"}),
    ('{"location":{"postcode":12345678901234567.5}}', {"postcode": "1.2345678901234568e+16"}),
    ('{"location":{"postcode":1E400}}', {"postcode": "inf"}),
    ('{"location":{"postcode":-1E400}}', {"postcode": "-inf"}),
    ('{"location":{"postcode":123456789012345678}}', {"postcode": "123456789012345678"}),
    ('{"location":{"postcode":12345678901234567890}}', {"postcode": "12345678901234567890"}),
    ('{"location":{"postcode":123456789012345678}}', {"postcode": "123456789012345678"}),
    ('{"location":{"postcode":true}}', {"postcode": "True"}),
    ('{"location":{"postcode":false}}', {"postcode": "False"}),
    ('{"location":{"postcode":"true"}}', {"postcode": "true"}),
    ('{"name":{"first":true,"last":""}}', {"full_name": "True "}),
    ('{"gender":7}', {"gender": "7"}),
    ('{"gender":100.00}', {"gender": "100.0"}),
    ('{"phone":1.50}', {"phone": "1.5"}),
    ('{"gender":true}', {"gender": "true"}),
    ('{"gender":{"a":1}}', {"gender": '{"a":1}'}),
    ('{"phone":[1,2]}', {"phone": "[1,2]"}),
    # Only the exact spelling of a key counts.
    ('{"Gender":"x"}', {}),
    (json.dumps(FULL), FULL_RECORD),
]

REJECTS = [
    ("null", "document is not an object"),
    ('"nope"', "document is not an object"),
    ("5", "document is not an object"),
    ("[]", "document is not an object"),
    ('{"location":{"street":"1 Main"}}', "location.street is not an object"),
    ('{"login":[]}', "login is not an object"),
    ('{"name":"{}"}', "name is not an object"),
    # The first container in the fixed order is named.
    ('{"picture":1,"location":null}', "location is not an object"),
]
for _path in CONTAINERS:
    _inner = "null"
    for _name in reversed(_path.split(".")):
        _inner = json.dumps({_name: json.loads(_inner)})
    REJECTS.append((_inner, f"{_path} is not an object"))


def documents(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    return frame.select("n", F.parse_json("text").alias("user"))


@pytest.fixture(scope="module")
def flattened(spark):
    texts = [text for text, _ in CASES] + [text for text, _ in REJECTS]
    rows = flatten_users(documents(spark, texts), F.lit("some id"), "n").collect()
    return {row.n: row for row in rows}


@pytest.mark.parametrize("n", range(len(CASES)), ids=[text[:50] for text, _ in CASES])
def test_record(flattened, n):
    row = flattened[n].asDict()
    assert row == {"n": n, "id": "some id", **EMPTY, **CASES[n][1]}


def test_column_order(spark):
    users = flatten_users(documents(spark, ["{}"]), F.lit("x"))
    assert tuple(users.columns) == USER_COLUMNS


def test_rejects_are_not_flattened(flattened):
    assert set(flattened) == set(range(len(CASES)))


def test_rejects_have_reason_and_text(spark):
    texts = [text for text, _ in REJECTS] + [text for text, _ in CASES]
    rows = flatten_rejects(documents(spark, texts), "n").collect()
    assert {row.n: row.reason for row in rows} == {i: why for i, (_, why) in enumerate(REJECTS)}
    assert {row.n: json.loads(row.document) for row in rows} == {
        i: json.loads(text) for i, (text, _) in enumerate(REJECTS)
    }


def test_numbers_are_spelled_as_python_spells_them(spark):
    """A number with a point or an exponent, of any size, against Python's own reading and writing."""
    rng = random.Random(2)
    texts = ["1.0", "0.5", "100000000.5", "9999999999999998.0", "1e15", "1e22", "0.1234567890123456789", "-7.25", "1.7976931348623157e308"]
    texts += [repr(rng.uniform(-1, 1) * 10 ** rng.randint(-20, 30)) for _ in range(500)]
    frame = spark.createDataFrame([(text,) for text in texts], "json string")
    longer = 0
    for row in frame.select("json", printed(F.parse_json("json")).alias("found")).collect():
        want = json.loads(row.json)
        assert float(row.found) == want
        longer += row.found != str(want)  # the JVM's digits are one too many for a few huge numbers
    assert longer <= 5
