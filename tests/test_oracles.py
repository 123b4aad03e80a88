"""Every registered query against its independent DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as entry_module
import oracle_sql
from daybook.plans.catalog import QUERIES
from harness import compare, duck

ORACLES = oracle_sql.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_dataset_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())


def test_oracles_share_no_code_with_the_datasets():
    with open(oracle_sql.__file__) as f:
        assert "daybook" not in f.read()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_small, con, name):
    df = QUERIES[name](spark, sf_small)
    ok, msg = compare(df, con, ORACLES[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "date"
