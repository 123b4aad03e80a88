"""Registry of every published dataset over the fixture ledgers.

Each entry takes (spark, sf_dir) and returns a DataFrame; the ledgers are
built from the supplied tables by ``daybook.sources.ledgers``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.sources import ledgers as L
from daybook.sources.exports import GAS_ASSET_HEX, NEO_ASSET_HEX

Query = Callable[[SparkSession, str], DataFrame]


def _tron(spark, d):
    from daybook.plans.tron import tron_stats

    return tron_stats(L.tron_blocks(spark, d))


def _tron_months(spark, d):
    """Months out of what days left, the later days numbered after the earlier ones."""
    from daybook.plans.tron import tron_day_parts, tron_months
    from daybook.streaming import Clock

    early, raw = _split(L.tron_blocks(spark, d), "timestamp", 1000)
    values, sets, numbers = tron_day_parts(early)
    begin = early.agg(F.max("timestamp")).first()[0]
    if begin is None:
        return tron_months(*tron_day_parts(raw)[:2])
    day = dt.datetime.fromtimestamp(begin // 1000, dt.UTC).replace(hour=0, minute=0, second=0, microsecond=0, tzinfo=None)
    more_values, more_sets, _ = tron_day_parts(Clock("timestamp", 1000).since(raw, day), numbers)
    closed = F.col("date") < F.lit(day)
    return tron_months(values.where(closed).unionByName(more_values), sets.where(closed).unionByName(more_sets))


def _stored(blocks_fn):
    """The ledger stored once, for jobs that read it several times: as a plan it would be built at each reading."""

    def run(spark, d):
        from daybook.operators.staging import frozen

        return frozen(blocks_fn(spark, d))

    return run


def _account(name, blocks_fn):
    def run(spark, d):
        from daybook.plans import account

        return getattr(account, name)(blocks_fn(spark, d))

    return run


def _ledger(name, blocks_fn):
    def run(spark, d):
        from daybook.plans import ledger

        return getattr(ledger, name)(blocks_fn(spark, d))

    return run


def _utxo(name, blocks_fn):
    def run(spark, d):
        from daybook.plans import utxo

        return getattr(utxo, name)(blocks_fn(spark, d))

    return run


def _eth(name, blocks_fn, **kw):
    def run(spark, d):
        from daybook.plans import ethereum

        return getattr(ethereum, name)(blocks_fn(spark, d), **kw)

    return run


def _erc20(spark, d):
    from daybook.plans.ethereum import erc20_transfers
    from daybook.sources.tokens import token_frame

    return erc20_transfers(L.eth_blocks(spark, d), token_frame(spark))


def _iota(spark, d):
    from daybook.plans.bundle import iota_stats

    return iota_stats(L.iota_txs(spark, d))


def _sync(spark, d):
    from daybook.streaming.synclog import sync_watermarks

    return sync_watermarks(
        {
            "cardano": L.cardano_blocks(spark, d),
            "ripple_payment_xrp": L.ripple_ledgers(spark, d),
            "stellar": L.stellar_ledgers(spark, d),
            "iota": L.iota_txs(spark, d),
            "monero": L.monero_blocks(spark, d),
            "nem": L.nem_blocks(spark, d),
            "neo": L.neo_blocks(spark, d),
            "lisk": L.lisk_block_times(spark, d),
            "eos": L.eos_blocks(spark, d),
            "waves": L.waves_blocks(spark, d),
        }
    )


class _Kept:
    """A per-day table as it is kept up: published from the early rows, refreshed with all of them."""

    def __init__(self, early, raw, clock, job, states=()):
        from daybook.operators.staging import scratch_path
        from daybook.streaming.publishing import STATES

        self.spark, self.raw, self.clock, self.job = raw.sparkSession, raw, clock, job
        self.path = scratch_path(self.spark)
        self.states = {kept: (STATES[state], scratch_path(self.spark)) for kept, state in dict(states).items()}
        self.refresh(early)

    def refresh(self, raw=None):
        from daybook.streaming import refresh_days

        refresh_days(self.job, self.raw if raw is None else raw, self.path, clock=self.clock, states=self.states)
        return self

    def read(self):
        from daybook.streaming import read_published

        return read_published(self.spark, self.path)


#: Seconds of raw history that the incremental queries leave to the refresh.
OPEN_SECONDS = 30 * 86400


def _split(raw, clock: str, per_second: int = 1, **options):
    """(raw rows before the open stretch, all raw rows), both read from one copy, stored with ``options``."""
    from daybook.operators.staging import frozen

    raw = frozen(raw, **options)
    last = raw.agg(F.max(clock)).first()[0]
    return raw.where(F.col(clock) < F.lit((last or 0) - OPEN_SECONDS * per_second)), raw


def _ripple_refreshed(spark, d):
    from daybook.plans.ledger import ripple_daily
    from daybook.streaming import Clock

    early, raw = _split(L.ripple_ledgers(spark, d), "closeTime")
    return _Kept(early, raw, Clock("closeTime"), lambda r, since=None: ripple_daily(r)).refresh().read()


def _neo_refreshed(spark, d):
    from daybook.plans.utxo import neo_stats
    from daybook.streaming import Clock

    early, raw = _split(L.neo_blocks(spark, d), "time")
    return _Kept(early, raw, Clock("time"), neo_stats, {"outputs": "neo_unspent"}).refresh().read()


def _kept_state(spark, raw, clock, name):
    """State ``name`` built before one day and brought forward to a later one, the two days' distance
    of ``OPEN_SECONDS``, and the raw rows from the later day on."""
    from daybook.operators.staging import frozen, scratch_path
    from daybook.streaming.publishing import STATES

    raw, path = frozen(raw), scratch_path(spark)
    last = dt.datetime.fromtimestamp(raw.agg(F.max(clock.column)).first()[0] or 0, dt.UTC).replace(tzinfo=None)
    late = dt.datetime(last.year, last.month, last.day) - dt.timedelta(days=5)
    STATES[name].before(raw, path, late - dt.timedelta(seconds=OPEN_SECONDS), clock)
    return STATES[name].before(raw, path, late, clock), clock.since(raw, late)


def _neo_unspent(spark, d):
    """Outputs left unspent, per day and asset: those of the closed days that the open ones leave, and their own."""
    from daybook.plans.utxo import neo_unspent_later
    from daybook.streaming import Clock

    state, later = _kept_state(spark, L.neo_blocks(spark, d), Clock("time"), "neo_unspent")
    kept, added = neo_unspent_later(state, later)
    return kept.unionByName(added).groupBy("date", "asset").agg(F.count(F.lit(1)).alias("cnt"), F.sum("value").alias("value"))


def _eth_short_addrs_refreshed(spark, d):
    """D07 out of the address totals of the closed days and the open days."""
    from daybook.plans.ethereum import address_totals, in_coins, merged_totals, short_addresses_of_totals
    from daybook.streaming import Clock

    state, later = _kept_state(spark, L.eth_blocks(spark, d), Clock("timestamp"), "ethereum_addresses")
    return in_coins(short_addresses_of_totals(merged_totals(state, address_totals(later))))


def _traced_refreshed(spark, d):
    from daybook.plans.ethereum import contract_days, eth_stats_traced
    from daybook.session import BLOCK_OPTIONS, few_blocks
    from daybook.streaming import Clock

    clock = Clock("timestamp")

    def job(r, since=None, earlier=None):
        return eth_stats_traced(r, "eth", "registry", since, registry.read(), earlier=earlier)

    with few_blocks(spark):
        early, raw = _split(L.eth_blocks(spark, d), "timestamp", **BLOCK_OPTIONS)
        registry = _Kept(early, raw, clock, lambda r, since=None: contract_days(r))
        stats = _Kept(early, raw, clock, job, {"earlier": "ethereum_addresses"})
        registry.refresh()
        return stats.refresh().read()


def _arrivals(raw, clock: str):
    """Raw rows as they reach a live table: the early ones, the open stretch, then some of the early ones that come late."""
    from daybook.operators.staging import frozen

    early, raw = _split(raw, clock)
    begin = early.agg(F.max(clock)).first()[0] or 0
    late = (F.col(clock) > F.lit(begin - OPEN_SECONDS)) & (F.pmod(F.xxhash64(clock), F.lit(3)) == 0)
    later = raw.where(F.col(clock) >= F.lit(begin)).join(early.select(clock).distinct(), clock, "left_anti")
    return [frozen(early.where(~late)), frozen(later.select(*raw.columns)), frozen(early.where(late))]


def _followed(spark, raw, clock, job, **kw):
    """A table kept up by a stream that is started again for each arrival."""
    from daybook.operators.staging import scratch_path
    from daybook.streaming import follow, read_published

    root = scratch_path(spark)
    for rows in _arrivals(raw, clock.column):
        rows.write.mode("append").parquet(f"{root}/raw")
        follow(spark, f"{root}/raw", rows.schema, f"{root}/table", job, clock=clock, checkpoint=f"{root}/progress", **kw)
    return read_published(spark, f"{root}/table")


def _ripple_live(spark, d):
    from daybook.plans.ledger import ripple_daily
    from daybook.streaming import Clock

    return _followed(spark, L.ripple_ledgers(spark, d), Clock("closeTime"), lambda r, since=None: ripple_daily(r))


def _ripple_payment_live(spark, d):
    """D20 kept live: days by their own ledgers, gaps out of stored runs that late ledgers join."""
    from daybook.operators.gaps import merged_runs, missing_of_runs, runs
    from daybook.operators.staging import scratch_path
    from daybook.plans.ledger import RIPPLE_SERIES_START, ripple_indexes, ripple_payment_days, with_gaps
    from daybook.streaming import Clock, stored_runs

    kept = scratch_path(spark)

    def note(rows):
        runs(ripple_indexes(rows), RIPPLE_SERIES_START).write.mode("append").parquet(kept)

    def job(rows, since=None):
        return ripple_payment_days(rows)

    # a payment's own date may be the day after its ledger closed
    days = _followed(spark, L.ripple_ledgers(spark, d), Clock("closeTime"), job, overlap=1, note=note)
    return with_gaps(days, missing_of_runs(merged_runs(stored_runs(spark, kept))))


def _waves_stored(spark, d):
    """Waves daily over a stored ledger whose older files lack the mass transfers' field."""
    from daybook.operators.staging import frozen, scratch_path
    from daybook.plans.account import waves_stats
    from daybook.sources.schemas import read_for

    raw, path = frozen(L.waves_blocks(spark, d)), scratch_path(spark)
    grown = F.exists("transactions", lambda t: t["type"] != 4)
    older = raw.where(~grown).withColumn("transactions", F.transform("transactions", lambda t: t.dropFields("transfers")))
    older.write.parquet(path)
    raw.where(grown).write.mode("append").parquet(path)
    return waves_stats(read_for(spark, path, "waves_stats"))


def _erc20_files(spark, d):
    """The token export end to end: list from JSON, stored nested ledger, a CSV folder a symbol, read back."""
    from daybook.operators.staging import scratch_path
    from daybook.session import BLOCK_OPTIONS, few_blocks
    from daybook.sources.exports import csv_view
    from daybook.sources.tokens import token_frame
    from daybook.streaming import read_published
    from daybook.streaming.publishing import export_erc20

    root = scratch_path(spark)
    with few_blocks(spark):
        L.eth_blocks(spark, d).write.options(compression="zstd", **BLOCK_OPTIONS).parquet(f"{root}/raw")
    fields = F.struct(F.col("address").alias("contractAddress"), "name", "symbol", "decimals")
    token_frame(spark).agg(F.to_json(F.collect_list(fields)).alias("value")).write.text(f"{root}/tokens")
    path = export_erc20(spark, f"{root}/raw", f"{root}/tokens", f"{root}/out")
    written = csv_view(read_published(spark, f"{root}/out/datasets/erc20transfers"), "erc20", keep=("symbol",))
    return spark.read.schema(written.schema).option("header", True).csv(path)


def _sync_log(spark, d):
    """The sync log as refreshes append to it: the last row of each chain."""
    from daybook.operators.staging import scratch_path
    from daybook.streaming import append_sync

    path = scratch_path(spark)
    for r in _sync(spark, d).collect():  # one row a chain
        append_sync(spark, path, r["view"], r["sync_time"])
    return spark.read.parquet(path).groupBy("view").agg(F.max_by("sync_time", "time").alias("sync_time"))


def _csv(dataset: str, export: str, where=None, keep=()):
    def run(spark, d):
        from daybook.sources.exports import csv_view

        return csv_view(QUERIES[dataset](spark, d), export, where=where, keep=keep)

    return run


QUERIES: dict[str, Query] = {
    "tron_stats": _tron,
    "tron_months": _tron_months,
    "eos_stats": _account("eos_stats", L.eos_blocks),
    "lisk_stats": _account("lisk_stats", L.lisk_trs),
    "nem_stats": _account("nem_stats", L.nem_blocks),
    "waves_stats": _account("waves_stats", L.waves_blocks),
    "ripple_payment_stats": _ledger("ripple_payment_stats", L.ripple_ledgers),
    "ripple_daily": _ledger("ripple_daily", L.ripple_ledgers),
    "stellar_payment_stats": _ledger("stellar_payment_stats", L.stellar_ledgers),
    "stellar_stats": _ledger("stellar_stats", L.stellar_ledgers),
    "cardano_stats": _utxo("cardano_stats", _stored(L.cardano_blocks)),
    "monero_stats": _utxo("monero_stats", L.monero_blocks),
    "neo_stats": _utxo("neo_stats", _stored(L.neo_blocks)),
    "iota_stats": _iota,
    "eth_tx": _eth("eth_tx", L.eth_blocks),
    "eth_actions": _eth("eth_actions", L.eth_blocks),
    "eth_contracts": _eth("eth_contracts", L.eth_blocks),
    "eth_short_addrs": _eth("eth_short_addrs", L.eth_blocks),
    "eth_short_tx": _eth("eth_short_tx", L.eth_blocks),
    "etc_short_tx": _eth("eth_short_tx", L.etc_blocks),
    "etc_stats": _eth("etc_stats", _stored(L.etc_blocks)),
    "eth_stats_traced": _eth("eth_stats_traced", _stored(L.eth_blocks), schedule="eth"),
    "etc_stats_traced": _eth("eth_stats_traced", _stored(L.etc_blocks), schedule="etc"),
    "eth_stats_traced_registry": _eth("eth_stats_traced", _stored(L.eth_blocks), schedule="eth", contracts="registry"),
    "erc20_transfers": _erc20,
    "sync_watermarks": _sync,
    "ripple_daily_refreshed": _ripple_refreshed,
    "ripple_daily_live": _ripple_live,
    "ripple_payment_live": _ripple_payment_live,
    "neo_stats_refreshed": _neo_refreshed,
    "neo_unspent": _neo_unspent,
    "waves_stats_stored": _waves_stored,
    "csv_erc20_files": _erc20_files,
    "sync_log": _sync_log,
    "eth_short_addrs_refreshed": _eth_short_addrs_refreshed,
    "eth_stats_traced_refreshed": _traced_refreshed,
}

QUERIES.update(
    {
        "csv_cardano": _csv("cardano_stats", "cardano"),
        "csv_ripple_payment_xrp": _csv("ripple_daily", "ripple_payment_xrp"),
        "csv_stellar_payment_xlm": _csv("stellar_payment_stats", "stellar_payment_xlm", where="asset = ''"),
        "csv_iota": _csv("iota_stats", "iota"),
        "csv_monero": _csv("monero_stats", "monero"),
        "csv_nem": _csv("nem_stats", "nem"),
        "csv_neo_gas": _csv("neo_stats", "neo", where=f"hex(asset) = '{GAS_ASSET_HEX.upper()}'"),
        "csv_neo_neo": _csv("neo_stats", "neo", where=f"hex(asset) = '{NEO_ASSET_HEX.upper()}'"),
        "csv_lisk": _csv("lisk_stats", "lisk"),
        "csv_eos": _csv("eos_stats", "eos"),
        "csv_waves": _csv("waves_stats", "waves"),
        "csv_eth_stats": _csv("eth_stats_traced_registry", "eth_stats"),
        "csv_eth_classic_stats": _csv("etc_stats_traced", "eth_stats"),
        "csv_erc20": _csv("erc20_transfers", "erc20", keep=("symbol",)),
    }
)
