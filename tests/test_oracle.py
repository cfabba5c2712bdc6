"""Every registered query against its SQL in another engine, on the smallest tables."""

import glob
import os

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__ as entry
from workload.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def other():
    connection = duckdb.connect()
    for path in glob.glob(f"{TESTDATA}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)):
        return round(float(value), 6) + 0.0
    return str(value)


def test_only_fits_and_the_listing_lack_sql():
    assert set(QUERIES) - set(ORACLES) == {
        "l4_logreg_fit_scratch",
        "l5_logreg_fit_library",
        "l10_compare_models_fitted",
    }


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, other, name):
    rows = QUERIES[name](spark, TESTDATA)
    columns = sorted(rows.columns)
    found = sorted((tuple(map(plain, row)) for row in rows.select(*[f"`{c}`" for c in columns]).collect()), key=str)
    cursor = other.execute(ORACLES[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == columns
    order = [names.index(column) for column in columns]
    expected = sorted((tuple(plain(row[i]) for i in order) for row in cursor.fetchall()), key=str)
    assert found == expected
    assert found or name not in ("c9_date_guard", "m6_nonnegative_days", "m7_late_coherent", "m8_shares_sum_to_one")


def test_flagship_query(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["estado", "taxa_atraso_percentual", "volume_pedidos"]
    assert rows.count() > 0
