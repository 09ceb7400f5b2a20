"""The queries that SQL can express, against DuckDB."""

import pytest

from docindex.llm.oracles import ORACLES
from docindex.llm.queries import QUERIES
from tests.compare import connect, duck_rows, spark_rows


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    names, rows = spark_rows(QUERIES[name](spark, sf_dir))
    assert (names, rows) == duck_rows(connect(sf_dir), ORACLES[name])
