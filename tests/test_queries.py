"""Every query against its expected result, computed by DuckDB from the same tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from tollgate.workload.oracles import ORACLES
from tollgate.workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    yield connection
    connection.close()


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float) and math.isnan(v):
            return "nan"
        return v

    return sorted([tuple(value(row[i]) for i in order) for row in rows], key=repr)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    result = contract.queries()[name](spark, SF_DIR)
    expected = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    got = _rows(result.columns, [tuple(r) for r in result.collect()])
    want = _rows(columns, expected.fetchall())
    assert len(got) == len(want)
    assert got == want


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert sum(r["n"] for r in rows) == 1000
    assert {r["routed_to"] for r in rows} == {"table", "dead_letter"}
