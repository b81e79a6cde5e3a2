"""Every registered query against its SQL on DuckDB, over whole tables."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

from rollbook.fixed import USER_COLUMNS
from rollbook.plans.oracles import ORACLES
from rollbook.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    relation = duck.sql(ORACLES[name])
    assert sorted(relation.columns) == columns
    types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    assert {c: TYPES[kind] for c, kind in frame.dtypes} == types
    order = ", ".join(f'"{column}"' for column in columns)
    expected = duck.execute(f"SELECT {order} FROM ({ORACLES[name]})").fetchall()
    found = [tuple(row) for row in frame.select(*[f"`{c}`" for c in columns]).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
    assert found


def test_flagship(spark):
    frame = entry.entry(spark)
    assert tuple(frame.columns) == USER_COLUMNS
    assert frame.count() > 0
