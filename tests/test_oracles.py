"""Every registered query against its SQL oracle in DuckDB, whole tables."""

import os

import duckdb
import pytest

from registered.oracles import ORACLES
from registered.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "DATE": "date", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLES[name])
    expected_types = {d[0]: TYPES[str(d[1])] for d in cursor.description}
    expected = cursor.fetchall()
    assert dict(got.dtypes) == expected_types
    columns = sorted(got.columns)
    rows = [tuple(r[c] for c in columns) for r in got.collect()]
    at = {d[0]: i for i, d in enumerate(cursor.description)}
    wanted = [tuple(r[at[c]] for c in columns) for r in expected]
    assert len(rows) == len(wanted) > 0
    assert sorted(rows, key=repr) == sorted(wanted, key=repr)
