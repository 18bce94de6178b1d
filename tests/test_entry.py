"""Every registered query against its SQL on the same tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from skyledger.suite.queries import REGISTRY

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def canonical(rows, columns):
    order = [columns.index(c) for c in sorted(columns)]
    text = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else repr(v)
    return sorted(tuple(text(row[i]) for i in order) for row in rows)


def test_every_query_has_its_sql():
    assert set(REGISTRY) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, database, name):
    df = entry.queries()[name](spark, FOLDER)
    cursor = database.execute(entry.oracle_sql()[name])
    types = {column[0]: str(column[1]) for column in cursor.description}
    expected = cursor.fetchall()
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    assert canonical(df.collect(), df.columns) == canonical(expected, [c[0] for c in cursor.description])


def test_entry(spark):
    assert entry.entry(spark).count() == 15
