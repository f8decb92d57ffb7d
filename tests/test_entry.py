"""Driver contract: entry, queries and oracle SQL (checked against DuckDB)."""

from __future__ import annotations

import importlib.util
import os
import re

import pytest

import __spark_entry__ as E
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.01"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 30
    assert df.columns[0] == "bucket"


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_numbered_operators_and_pipeline_are_there_with_their_package():
    numbered = [n for n in E.queries() if re.match(r"op\d+_", n)]
    there = importlib.util.find_spec("tidemark.llm") is not None
    assert len(numbered) == (13 if there else 0)
    assert ("pipeline" in E.queries()) == (there and importlib.util.find_spec("corpus_pipeline") is not None)


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, SF)
    assert r["ok"] is not False, r.get("problems")
