"""Refresh and export one chain end to end.

For each chain this is what a periodic refresh does: bring the stored tables
it depends on up to date, fix the watermark, publish the dataset (full
rebuild, or the open days only for incrementally kept datasets), append the
sync-log row, write the CSV exports, and remove what was staged on the way.
Each step is a Spark job; the driver only sequences them.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from daybook.operators.staging import scope
from daybook.plans import account, bundle, ethereum, ledger, tron, utxo
from daybook.session import few_blocks
from daybook.sources.exports import GAS_ASSET_HEX, NEO_ASSET_HEX, csv_view, write_csv
from daybook.sources.schemas import read_for
from daybook.sources.tokens import load_tokens
from daybook.streaming.clocks import Clock
from daybook.streaming.refresh import refresh_days
from daybook.streaming.state import State
from daybook.streaming.store import publish, read_published
from daybook.streaming.synclog import append_sync, watermark


@dataclass(frozen=True)
class Export:
    name: str  # file (folder) name of the CSV
    spec: str  # key of sources.exports.EXPORTS; None writes the dataset as is
    where: str | None = None
    keep: tuple[str, ...] = ()
    partition_by: str | None = None


@dataclass(frozen=True)
class Chain:
    """``job(raw, stored, since)`` gives a dataset; ``stored`` holds the
    current rows of the published tables named in ``needs``, and with ``since``
    the ``states``."""

    job: Callable[[DataFrame, dict[str, DataFrame], object], DataFrame]
    schema: str  # narrow read schema key (sources/schemas.py)
    clock: Clock | None = None  # set for incrementally kept datasets
    needs: tuple[str, ...] = ()
    states: tuple[str, ...] = ()  # of STATES, handed on as they were before the open days
    sync_view: str | None = None
    exports: tuple[Export, ...] = field(default_factory=tuple)


def _whole(fn: Callable[[DataFrame], DataFrame]):
    return lambda raw, stored, since: fn(raw)


def _hex_asset(h: str) -> str:
    return f"hex(asset) = '{h.upper()}'"


def _traced(schedule: str):
    def job(raw, stored, since):
        return ethereum.eth_stats_traced(
            raw, schedule, contracts="registry", since=since,
            contract_registry=stored["ethereum_contract_days"], earlier=stored.get("ethereum_addresses"),
        )

    return job


_ETH_CLOCK = Clock("timestamp")

#: What closed days leave to later ones.
STATES: dict[str, State] = {
    "neo_unspent": State(utxo.OUTPOINT, utxo.neo_unspent, utxo.neo_unspent_later),
    "ethereum_addresses": State(
        ("address",), ethereum.address_totals,
        lambda totals, raw: (ethereum.merged_totals(totals, ethereum.address_totals(raw)), None),
    ),
}

# What each refresh publishes and exports (dataset, sync view,
# CSV files), as the reference's refresh scripts do.
CHAINS: dict[str, Chain] = {
    "cardano": Chain(_whole(utxo.cardano_stats), "cardano_stats", sync_view="cardano", exports=(Export("cardano", "cardano"),)),
    "ripple_payment_xrp": Chain(
        _whole(ledger.ripple_daily), "ripple_daily", Clock("closeTime"), sync_view="ripple_payment_xrp",
        exports=(Export("ripple_payment_xrp", "ripple_payment_xrp"),),
    ),
    "stellar_payment": Chain(
        _whole(ledger.stellar_payment_stats), "stellar_payment_stats", sync_view="stellar",
        exports=(Export("stellar_payment_xlm", "stellar_payment_xlm", where="asset = ''"),),
    ),
    "stellar": Chain(
        lambda raw, stored, since: ledger.stellar_stats(raw, stored["stellar_payment"]), "stellar_stats",
        needs=("stellar_payment",), exports=(Export("stellar", None),),
    ),
    "iota": Chain(_whole(bundle.iota_stats), "iota_stats", sync_view="iota", exports=(Export("iota", "iota"),)),
    "monero": Chain(_whole(utxo.monero_stats), "monero_stats", sync_view="monero", exports=(Export("monero", "monero"),)),
    "nem": Chain(_whole(account.nem_stats), "nem_stats", sync_view="nem", exports=(Export("nem", "nem"),)),
    "neo_outputs": Chain(_whole(utxo.neo_outputs), "neo_stats", Clock("time")),
    "neo": Chain(
        lambda raw, stored, since: utxo.neo_stats(raw, since, stored.get("neo_unspent")), "neo_stats", Clock("time"),
        states=("neo_unspent",), sync_view="neo",
        exports=(Export("neo_gas", "neo", where=_hex_asset(GAS_ASSET_HEX)),
                 Export("neo_neo", "neo", where=_hex_asset(NEO_ASSET_HEX))),
    ),
    "lisk": Chain(_whole(account.lisk_stats), "lisk_stats", sync_view="lisk", exports=(Export("lisk", "lisk"),)),
    "eos": Chain(_whole(account.eos_stats), "eos_stats", sync_view="eos", exports=(Export("eos", "eos"),)),
    "waves": Chain(_whole(account.waves_stats), "waves_stats", sync_view="waves", exports=(Export("waves", "waves"),)),
    "tron": Chain(_whole(tron.tron_stats), "tron_stats"),
    "ethereum_tx": Chain(_whole(ethereum.eth_tx), "eth_tx", _ETH_CLOCK),
    "ethereum_actions": Chain(_whole(ethereum.eth_actions), "eth_actions", _ETH_CLOCK),
    "ethereum_contract_days": Chain(_whole(ethereum.contract_days), "eth_contracts", _ETH_CLOCK),
    "ethereum_address_days": Chain(_whole(ethereum.address_days), "eth_short_addrs", _ETH_CLOCK),
    "ethereum_contracts": Chain(
        lambda raw, stored, since: stored["ethereum_contract_days"].select("address").distinct(), "eth_contracts",
        needs=("ethereum_contract_days",),
    ),
    "ethereum_short_addrs": Chain(
        lambda raw, stored, since: ethereum.in_coins(ethereum.short_addresses_of_days(stored["ethereum_address_days"])),
        "eth_short_addrs", needs=("ethereum_address_days",),
    ),
    "ethereum_stats_traced": Chain(
        _traced("eth"), "eth_stats_traced", _ETH_CLOCK, needs=("ethereum_contract_days",), states=("ethereum_addresses",),
        exports=(Export("eth_stats", "eth_stats"),),
    ),
    "ethereum_classic_stats_traced": Chain(
        _whole(lambda b: ethereum.eth_stats_traced(b, "etc")), "eth_stats_traced",
        exports=(Export("eth_classic_stats", "eth_stats"),),
    ),
}


def _target(out_root: str, name: str) -> str:
    return os.path.join(out_root, "datasets", name)


def refresh_chain(
    spark: SparkSession,
    name: str,
    raw_path: str,
    out_root: str,
    *,
    full: bool = False,
    sync_source: DataFrame | None = None,
) -> dict[str, str]:
    """Publish ``name``'s dataset, append its sync row, write its CSVs.

    Tables the dataset needs are refreshed first.  Returns the paths written.
    ``sync_source`` is the table whose clock the sync log records (the raw
    table itself by default; Lisk keeps it in a separate block table).
    """
    chain = CHAINS[name]
    for needed in chain.needs:
        refresh_chain(spark, needed, raw_path, out_root, full=full)
    raw = read_for(spark, raw_path, chain.schema)  # one listing for watermark and job
    sync_time = watermark(chain.sync_view, raw if sync_source is None else sync_source) if chain.sync_view else None
    stored = {needed: read_published(spark, _target(out_root, needed)) for needed in chain.needs}
    target = _target(out_root, name)

    def job(rows: DataFrame, since=None, **states: DataFrame) -> DataFrame:
        return chain.job(rows, {**stored, **states}, since)

    if chain.clock is not None:
        states = {s: (STATES[s], os.path.join(out_root, "states", s)) for s in chain.states}
        refresh_days(job, raw, target, clock=chain.clock, full=full, states=states)
    else:
        with scope(spark):
            publish(job(raw), target)
    written = {"dataset": target}
    if chain.sync_view:
        written["sync_log"] = os.path.join(out_root, "sync_log")
        append_sync(spark, written["sync_log"], chain.sync_view, sync_time)
    for ex in chain.exports:
        published = read_published(spark, target)
        view = published if ex.spec is None else csv_view(published, ex.spec, where=ex.where, keep=ex.keep)
        path = os.path.join(out_root, "csv", ex.name)
        write_csv(view, path, partition_by=ex.partition_by)
        written[ex.name] = path
    return written


def export_erc20(spark: SparkSession, raw_path: str, tokens_path: str, out_root: str) -> str:
    """Refresh the ERC20 dataset from the JSON token list at ``tokens_path``
    and write one CSV folder per symbol (S3, S8)."""
    target = _target(out_root, "erc20transfers")
    with scope(spark), few_blocks(spark):
        publish(ethereum.erc20_transfers(read_for(spark, raw_path, "erc20_transfers"), load_tokens(spark, tokens_path)), target)
    view = csv_view(read_published(spark, target), "erc20", keep=("symbol",))
    path = os.path.join(out_root, "csv", "erc20")
    write_csv(view, path, partition_by="symbol")
    return path
