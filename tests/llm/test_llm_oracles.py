"""Operators that SQL can express, against DuckDB over the small tables and over edge rows."""

import pytest

from daybook.llm.queries import ORACLES, QUERIES
from harness import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf_small, name):
    ok, msg = compare(QUERIES[name](spark, sf_small), duck(sf_small), ORACLES[name])
    assert ok, msg
