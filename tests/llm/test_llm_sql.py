"""Every query that SQL can express against its SQL in another engine, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from parcelwise.llm.queries import ORACLES, QUERIES

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def other():
    connection = duckdb.connect()
    for path in glob.glob(f"{TESTDATA}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, other, name):
    rows = QUERIES[name](spark, TESTDATA)
    columns = sorted(rows.columns)
    cursor = other.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    expected = sorted((tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall()), key=str)
    assert sorted((tuple(row) for row in rows.select(*columns).collect()), key=str) == expected


def test_all_operators_and_the_pipeline_are_registered():
    found = entry.queries()
    for n in range(1, 14):
        assert len([q for q in found if q.startswith(f"op{n}_")]) == 1
    assert "pipeline" in found
