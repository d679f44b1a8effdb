"""Each registered query against its SQL twin, on the driver's tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.01"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the driver's tables")
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    result = duck.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    expected = canonical(columns, result.fetchall())
    assert expected
    assert canonical(frame.columns, frame.collect()) == expected


def test_flagship(spark):
    rows = contract.entry(spark).collect()
    assert [r["page_category"] for r in rows][0] == "Very Short (<100)"
    assert math.isclose(sum(r["percentage"] for r in rows), 100, abs_tol=0.1)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
