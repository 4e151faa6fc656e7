"""Every registered query against its SQL in a second engine, on two sizes of the tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIRS = [Path("/root/testdata/sf0.001"), Path("/root/testdata/sf0.01")]
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}

pytestmark = pytest.mark.skipif(not all(d.exists() for d in SF_DIRS), reason="needs the driver's tables")


@pytest.fixture(scope="module", params=SF_DIRS, ids=lambda d: d.name)
def tables(request):
    """A folder of tables, and a connection that shows them as views."""
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in sorted(request.param.glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return str(request.param), connection


def test_every_query_has_its_sql():
    assert set(entry.QUERIES) == set(entry.ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    result = entry.entry(spark)
    assert result.count() == 16 and len(result.columns) == 28


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query_matches_sql(spark, tables, name):
    sf_dir, duck = tables
    result = entry.queries()[name](spark, sf_dir)
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    types = dict(result.dtypes)
    assert {n: TYPES[types[n]] for n in types} == {c[0]: str(c[1]) for c in cursor.description}

    def comparable(rows, names):
        order = sorted(range(len(names)), key=lambda i: names[i])
        return sorted([repr(r[i]) for i in order] for r in rows)

    assert comparable(result.collect(), result.columns) == comparable(cursor.fetchall(), columns)
