"""Gap buckets made tiny, so that successors cross bucket borders constantly."""

import oracle_sql
from daybook.operators import gaps
from daybook.plans.catalog import QUERIES
from harness import compare, duck


def test_tiny_gap_buckets_match_oracle(spark, sf_small, monkeypatch):
    monkeypatch.setattr(gaps, "DEFAULT_BUCKET_WIDTH", 16)
    df = QUERIES["ripple_payment_stats"](spark, sf_small)
    ok, msg = compare(df, duck(sf_small), oracle_sql.oracle_sql()["ripple_payment_stats"])
    assert ok, msg
