"""Every registered query against its SQL counterpart in DuckDB."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from millrace.workload.queries import QUERIES as CORE

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = "nation customer supplier part orders lineitem events".split()

# The text operators have tests of their own.
QUERIES = {name: contract.queries()[name] for name in CORE}
ORACLES = {name: sql for name, sql in contract.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


# DuckDB type -> Spark type
SAME_TYPE = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    frame = QUERIES[name](spark, SF_DIR)
    result = db.execute(ORACLES[name])
    types = {column[0]: SAME_TYPE[str(column[1])] for column in result.description}
    columns = sorted(types)
    assert sorted(frame.columns) == columns
    assert dict(frame.dtypes) == types

    order = [list(types).index(column) for column in columns]
    want = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    got = Counter(tuple(row) for row in frame.select(*columns).collect())
    assert sum(want.values()) > 0
    assert got - want == Counter()
    assert want - got == Counter()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_is_the_hourly_report(spark):
    frame = contract.entry(spark)
    assert frame.columns == [
        "pickup_zone",
        "pickup_hour",
        "total_trips",
        "avg_fare",
        "avg_distance",
        "total_revenue",
    ]
    assert frame.count() == 4894
