"""Every registered query of the subpackage against its SQL, or its rows."""

import duckdb
import pytest

import __spark_entry__ as contract
from amberline.llm.oracle import ORACLE
from amberline.llm.queries import QUERIES
from tests.test_oracle import TABLES, table

ROWS_ONLY = {"op3_toxicity", "op4_bpe", "op6_token_files", "op7_packing", "op8_html", "pipeline"}


@pytest.fixture(scope="module")
def duck(data):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    yield connection
    connection.close()


def test_registered():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(name, spark, data, duck):
    frame = QUERIES[name](spark, data)
    cursor = duck.execute(ORACLE[name])
    assert table(frame.columns, frame.collect()) == table([c[0] for c in cursor.description], cursor.fetchall())
