"""Conservation properties of the published datasets."""

import pytest
from pyspark.sql import functions as F

from daybook.functions import day_of_seconds
from daybook.operators.gaps import missing_ranges
from daybook.plans.catalog import QUERIES
from daybook.sources import ledgers as L


@pytest.mark.parametrize("name", ["tron_stats", "eos_stats", "lisk_stats", "nem_stats", "waves_stats", "ripple_daily"])
def test_union_bounds(spark, sf_small, name):
    """from ≤ union ≤ from + to, per day."""
    df = QUERIES[name](spark, sf_small).where(F.col("addr_cnt").isNotNull())
    bad = df.where(
        (F.col("addr_cnt") < F.greatest("from_cnt", "to_cnt")) | (F.col("addr_cnt") > F.col("from_cnt") + F.col("to_cnt"))
    )
    assert df.count() > 0 and bad.count() == 0


def test_gaps_plus_blocks_cover_the_range(spark, sf_small):
    """Σ gap sizes + ledgers present = index range from the series start (C11)."""
    led = L.ripple_ledgers(spark, sf_small).select("index", day_of_seconds("closeTime").alias("date"))
    start = L.RIPPLE_FIRST_INDEX + 1
    present = led.where(F.col("index") >= start - 1)
    lo, hi, n = present.agg(F.min("index"), F.max("index"), F.count(F.lit(1))).first()
    gaps = missing_ranges(led, start)
    total = gaps.agg(F.sum("cnt")).first()[0] or 0
    assert total > 0
    assert total + n == hi - lo + 1


def test_cardano_fees_are_minus_net(spark, sf_small):
    """Per day, Σ fees = Σ inputs − Σ outputs."""
    from daybook.operators.flows import signed_rows

    tx = L.cardano_blocks(spark, sf_small).select(F.explode("transactions").alias("tx")).select(
        day_of_seconds("tx.timeIssued").alias("date"), F.col("tx.inputs").alias("i"), F.col("tx.outputs").alias("o")
    )
    net = signed_rows(tx, "i", "o", ["date"]).groupBy("date").agg((-F.sum("value") / 10**6).alias("net"))
    fees = QUERIES["cardano_stats"](spark, sf_small).select("date", "fees")
    j = fees.join(net, "date")
    assert j.count() > 0 and j.where(F.col("fees") != F.col("net")).count() == 0


def test_fixture_exercises_edge_cases(spark, sf_small):
    """The fixture ledgers hit the branches the datasets must handle."""
    eth = QUERIES["eth_stats_traced"](spark, sf_small)
    assert eth.where(F.col("reward").isNull()).count() > 0  # days without uncles (Q8)
    assert eth.where(F.col("create_contract_cnt") > 0).count() > 0
    assert eth.where(F.col("contract_cnt") > 0).count() > 0
    assert eth.where(F.col("short_cnt") > 0).count() > 0
    assert QUERIES["cardano_stats"](spark, sf_small).where(F.col("short_volume") > 0).count() > 0
    assert QUERIES["ripple_payment_stats"](spark, sf_small).where(F.col("missing_block_cnt") > 0).count() > 0
    tokens = QUERIES["erc20_transfers"](spark, sf_small)
    assert tokens.where((F.col("overflow_cnt") > 0) & F.col("value").isNull() & F.col("value_text").isNotNull()).count() > 0
    assert tokens.where((F.col("overflow_cnt") == 0) & F.col("value").isNotNull()).count() > 0
