"""Every query against its SQL equivalent on the given tables."""

import math
from datetime import datetime

import duckdb
import pytest

import __spark_entry__ as contract
from amberline.plans.catalog import QUERIES
from amberline.plans.oracle import ORACLE

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(data):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
    yield connection
    connection.close()


def plain(value):
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(body, key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(name, spark, data, duck):
    frame = QUERIES[name](spark, data)
    got = table(frame.columns, frame.collect())
    cursor = duck.execute(ORACLE[name])
    want = table([entry[0] for entry in cursor.description], cursor.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
    types = [[type(v).__name__ for v in row] for row in (got[1][:1], want[1][:1]) for row in row]
    assert types[0] == types[1]


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert rows and rows[0].location == "Denver"
