"""Every registered query against its SQL on the smallest scale factor."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_point
from tidemark.workload.oracle import ORACLE
from tidemark.workload.queries import QUERIES

TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "TIMESTAMP": "timestamp_ntz",
    "DATE": "date",
    "BOOLEAN": "boolean",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def duck(small):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    return connection


def canonical(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else repr(value)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, small, name):
    result = entry_point.queries()[name](spark, small)
    cursor = duck.execute(entry_point.oracle_sql()[name])
    described = [(d[0], TYPES.get(str(d[1]), str(d[1]))) for d in cursor.description]
    assert sorted(result.dtypes) == sorted(described)
    order = [c for c, _ in described]
    ours = sorted(tuple(canonical(r[c]) for c in order) for r in result.collect())
    theirs = sorted(tuple(canonical(v) for v in r) for r in cursor.fetchall())
    assert ours == theirs
