"""Every registered query against its SQL, on the smallest driver tables."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    result = queries()[name](spark, str(DATA))
    columns = sorted(result.columns)
    found = sorted(repr(tuple(row)) for row in result.select(*columns).collect())
    relation = duck.execute(oracle_sql()[name])
    names = [d[0] for d in relation.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = sorted(repr(tuple(row[i] for i in places)) for row in relation.fetchall())
    assert found and found == expected


def test_flagship_query_runs(spark):
    assert entry(spark).count() > 0
