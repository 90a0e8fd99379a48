"""Every registered query against its SQL on the given tables."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from suite import oracles, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = queries.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')"
        )
    return connection


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(v):
        if isinstance(v, float) and math.isnan(v):
            return "nan"
        if isinstance(v, Decimal):
            return f"decimal {v}"
        return f"{type(v).__name__} {v!r}"

    return sorted(tuple(value(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, database, name):
    result = QUERIES[name](spark, SF)
    cursor = database.execute(ORACLES[name])
    names = [column[0] for column in cursor.description]
    assert sorted(result.columns) == sorted(names)
    expected = cursor.fetchall()
    actual = [tuple(row) for row in result.collect()]
    assert canonical(actual, result.columns) == canonical(expected, names)
    assert actual, "an empty result checks nothing"


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
