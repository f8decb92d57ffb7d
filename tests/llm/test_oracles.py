"""Queries that SQL can express, against DuckDB on the same tables."""

import pytest

from tests.oracle_harness import compare, duck
from tidemark.llm.oracles import ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    assert compare(spark, duck(sf), name, sf)["ok"]
