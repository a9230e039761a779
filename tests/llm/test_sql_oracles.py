"""Queries that SQL can express, against DuckDB over whole tables."""

import os

import pytest

from lakeferry.llm.queries import ORACLES, QUERIES
from tests.compare import differences, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_sql(spark, key):
    assert differences(QUERIES[key](spark, SF_DIR), duck(SF_DIR), ORACLES[key]) is None


def test_one_query_an_operator():
    numbers = sorted(int(k[2:].split("_")[0]) for k in QUERIES if k.startswith("op"))
    assert numbers == list(range(1, 14))
