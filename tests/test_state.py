"""Bucketed state of closed days: equal to a whole build, met without a shuffle of it, safe against dead writes."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from daybook.plans import ethereum, utxo
from daybook.sources import ledgers as L
from daybook.streaming import Clock
from daybook.streaming.publishing import STATES
from daybook.streaming.state import last_write

NEO, ETH = Clock("time"), Clock("timestamp")
DAY = dt.timedelta(days=1)


def rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)


@pytest.fixture(scope="module")
def neo(spark, sf_small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("neo"))
    L.neo_blocks(spark, sf_small).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def eth(spark, sf_small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("eth"))
    L.eth_blocks(spark, sf_small).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def days_of(raw, clock, *shares):
    """Days that lie at these shares of the raw rows' stretch."""
    low, high = raw.agg(F.min(clock.column), F.max(clock.column)).first()
    at = [dt.datetime(1970, 1, 1) + dt.timedelta(seconds=low + int((high - low) * s)) for s in shares]
    return [dt.datetime(t.year, t.month, t.day) for t in at]


@pytest.mark.parametrize("name", ["neo_unspent", "ethereum_addresses"])
def test_steps_equal_one_build(spark, neo, eth, scratch, name):
    raw, clock = (neo, NEO) if name.startswith("neo") else (eth, ETH)
    state = STATES[name]
    for day in days_of(raw, clock, 0.3, 0.5, 0.9):
        got = state.before(raw, scratch, day, clock)
        assert rows(got) == rows(state.build(clock.before(raw, day))) != []
        assert got.dtypes == state.before(raw, scratch, day, clock).dtypes
    assert last_write(spark, scratch)["seq"] == 3  # asking again for the same day wrote nothing


def exchanges(df, spark):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan, len(re.findall(r"\bExchange ", plan))


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_history_is_not_shuffled(spark, neo, eth, scratch, no_broadcast):
    """One exchange, that of the open rows, wherever a state is met or brought forward."""
    day, = days_of(neo, NEO, 0.8)
    unspent = STATES["neo_unspent"].before(neo, f"{scratch}/neo", day, NEO)
    open_rows = NEO.since(neo, day)
    spent = utxo.outpoint_spends(utxo.neo_spends(open_rows), unspent)
    kept, _ = utxo.neo_unspent_later(unspent, open_rows)
    day, = days_of(eth, ETH, 0.8)
    totals = STATES["ethereum_addresses"].before(eth, f"{scratch}/eth", day, ETH)
    later = ethereum.address_totals(ETH.since(eth, day))
    merged = ethereum.merged_totals(totals, later)
    short = ethereum.short_addresses_of_totals(later, totals)
    for df in (spent, kept, merged, short):
        plan, n = exchanges(df, spark)
        assert n == 1 and "Bucketed: true" in plan, plan


def test_another_session_finds_it_again(spark, neo, scratch):
    state, (day,) = STATES["neo_unspent"], days_of(neo, NEO, 0.5)
    want = rows(state.before(neo, scratch, day, NEO))
    for t in spark.catalog.listTables():
        if t.name.startswith("daybook_state_"):
            spark.sql(f"DROP TABLE {t.name}")
    assert rows(state.before(neo, scratch, day, NEO)) == want
    assert last_write(spark, scratch)["seq"] == 1


def test_a_write_that_died_is_not_read(spark, neo, scratch):
    state, (a, b) = STATES["neo_unspent"], days_of(neo, NEO, 0.5, 0.6)
    first = state.before(neo, scratch, a, NEO)
    first.limit(3).write.parquet(f"{scratch}/half")  # a folder without its log row
    assert rows(state.before(neo, scratch, b, NEO)) == rows(utxo.neo_unspent(NEO.before(neo, b)))


def test_an_earlier_day_is_built_anew(spark, neo, scratch):
    """A published table that was reset to an earlier day gets the state of that day."""
    state, (a, b) = STATES["neo_unspent"], days_of(neo, NEO, 0.4, 0.8)
    state.before(neo, scratch, b, NEO)
    assert rows(state.before(neo, scratch, a, NEO)) == rows(utxo.neo_unspent(NEO.before(neo, a)))


def test_empty_states(spark, neo, scratch):
    """Before the first day there is nothing; the state then grows from that."""
    state, (first,) = STATES["neo_unspent"], days_of(neo, NEO, 0)
    assert rows(state.before(neo, scratch, first - DAY, NEO)) == []
    later = first + 9 * DAY
    assert rows(state.before(neo, scratch, later, NEO)) == rows(utxo.neo_unspent(NEO.before(neo, later))) != []
