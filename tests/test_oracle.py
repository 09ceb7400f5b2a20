"""Every query against its SQL."""

import pytest

import __spark_entry__ as contract
from docindex.oracles import ORACLES
from docindex.queries import QUERIES
from tests.compare import connect, duck_rows, spark_rows

# Row counts of FIXTURES.md for the smallest data.
COUNTS = {
    "detect_new_or_changed": 60,
    "detect_deleted": 20,
    "chunk_docs": 649,
    "embed_backlog_by_id": 89,
    "embed_backlog_by_content": 109,
    "incremental_index": 649,
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    assert rows, "no rows to compare"
    assert len(rows) == COUNTS.get(name, len(rows))
    if name in ORACLES:
        expected_columns, expected = duck_rows(duck, ORACLES[name])
        assert columns == expected_columns
        assert rows == expected


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert "chunkId" in df.columns
