"""Incremental refresh equals a full rebuild; exports and the sync log round-trip."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from daybook.operators import staging
from daybook.plans import ethereum, ledger, utxo
from daybook.plans.catalog import QUERIES
from daybook.sources import ledgers as L
from daybook.sources.exports import EXPORTS, GAS_ASSET_HEX, NEO_ASSET_HEX, csv_view, write_csv
from daybook.streaming import Clock, last_published_day, publish, read_published, refresh_days
from daybook.streaming.publishing import CHAINS, refresh_chain


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)


def _neo(stored):
    return lambda raw, since=None: utxo.neo_stats(raw, since, None if since is None else stored)


def _eth(registry, addresses):
    return lambda raw, since=None: ethereum.eth_stats_traced(
        raw, contracts="registry", since=since,
        contract_registry=None if since is None else registry, addresses=None if since is None else addresses,
    )


def case(spark, sf, name):
    """(raw rows, job, clock) of an incrementally kept dataset."""
    if name == "ripple":
        return L.ripple_ledgers(spark, sf), lambda raw, since=None: ledger.ripple_daily(raw), Clock("closeTime")
    if name == "neo":
        raw = L.neo_blocks(spark, sf)
        return raw, _neo(utxo.neo_outputs(raw)), Clock("time")
    raw = L.eth_blocks(spark, sf)
    return raw, _eth(ethereum.contract_days(raw), ethereum.address_days(raw)), Clock("timestamp")


@pytest.mark.parametrize("name", ["ripple", "neo", "eth"])
@pytest.mark.parametrize("cut", [dt.datetime(1996, 6, 1), dt.datetime(2000, 1, 1)])
def test_incremental_equals_full(spark, sf_small, scratch, name, cut):
    raw, job, clock = case(spark, sf_small, name)
    target = os.path.join(scratch, name)
    assert last_published_day(spark, target) is None
    early = job(raw.where(F.col(clock.column) < int((cut - dt.datetime(1970, 1, 1)).total_seconds())))
    early_rows = _rows(early)
    publish(early, target)
    begin = last_published_day(spark, target)
    assert begin is not None and begin < cut
    assert refresh_days(job, raw, target, clock=clock) == begin
    out, full = read_published(spark, target), job(raw)
    # Open days (from the last published one on) equal a full rebuild ...
    assert _rows(out.where(F.col("date") >= begin)) == _rows(full.where(F.col("date") >= begin))
    # ... and closed days keep what was published (§8 Q4).
    assert _rows(out.where(F.col("date") < begin)) == [r for r in early_rows if r[sorted(early.columns).index("date")] < begin]
    if name != "eth":  # history-independent closed days also equal the rebuild
        assert _rows(out) == _rows(full)


def days(spark, *rows):
    return spark.createDataFrame([(dt.datetime(2020, 1, d), v) for d, v in rows], "date timestamp_ntz, v int")


def published(spark, path):
    return {(r["date"].day, r["v"]) for r in read_published(spark, path).collect()}


def test_recomputed_day_without_rows_disappears(spark, scratch):
    path = f"{scratch}/t"
    publish(days(spark, (1, 1), (2, 1), (3, 1)), path)
    publish(days(spark, (3, 2), (4, 2)), path, begin=dt.datetime(2020, 1, 3))
    assert published(spark, path) == {(1, 1), (2, 1), (3, 2), (4, 2)}
    publish(days(spark, (4, 3)), path, begin=dt.datetime(2020, 1, 3))  # day 3 has no rows any more
    assert published(spark, path) == {(1, 1), (2, 1), (4, 3)}
    publish(days(spark), path, begin=dt.datetime(2020, 1, 2))
    assert published(spark, path) == {(1, 1)}


def test_closed_days_survive_without_success_marks_and_old_raw(spark, sf_small, scratch):
    """Raw kept for newer days only, no _SUCCESS files: closed days stay."""
    raw, job, clock = case(spark, sf_small, "ripple")
    path = f"{scratch}/t"
    publish(job(raw), path)
    for folder, _, files in os.walk(path):
        for f in files:
            if "_SUCCESS" in f:
                os.remove(os.path.join(folder, f))
    before = _rows(read_published(spark, path))
    last = last_published_day(spark, path)
    refresh_days(job, raw.where(F.col("closeTime") >= int((last - dt.datetime(1970, 1, 1)).total_seconds())), path, clock=clock)
    assert _rows(read_published(spark, path)) == before


def test_a_write_that_died_changes_nothing(spark, scratch):
    path = f"{scratch}/t"
    publish(days(spark, (1, 1), (2, 1)), path)
    days(spark, (2, 9), (3, 9)).write.parquet(f"{path}/.spark-staging-1/month=202001")  # what such a write leaves
    assert published(spark, path) == {(1, 1), (2, 1)}
    publish(days(spark, (2, 2)), path, begin=dt.datetime(2020, 1, 2))
    assert published(spark, path) == {(1, 1), (2, 2)} and last_published_day(spark, path) == dt.datetime(2020, 1, 2)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def dated(spark, *rows):
    return spark.createDataFrame([(dt.datetime(2020, m, d), v) for m, d, v in rows], "date timestamp_ntz, v int")


def test_closed_months_keep_their_files(spark, scratch):
    path = f"{scratch}/t"
    publish(dated(spark, *[(m, d, m * 100 + d) for m in range(1, 5) for d in (1, 9)]), path)
    before = files(path)
    publish(dated(spark, (3, 9, 1), (5, 2, 2)), path, begin=dt.datetime(2020, 3, 9))  # April has no rows any more
    after = files(path)
    closed = {f: t for f, t in before.items() if f.split("month=")[1][:6] < "202003"}
    assert len(closed) == 2 and closed.items() <= after.items() and len(after) == 4
    rows = {(r["date"].month, r["date"].day, r["v"]) for r in read_published(spark, path).collect()}
    assert rows == {(1, 1, 101), (1, 9, 109), (2, 1, 201), (2, 9, 209), (3, 1, 301), (3, 9, 1), (5, 2, 2)}
    assert last_published_day(spark, path) == dt.datetime(2020, 5, 2)


def test_a_table_without_rows_keeps_its_schema(spark, scratch):
    path = f"{scratch}/t"
    publish(days(spark), path)
    assert read_published(spark, path).dtypes == [("date", "timestamp_ntz"), ("v", "int")] and published(spark, path) == set()
    publish(days(spark, (5, 1)), path, begin=last_published_day(spark, path))
    assert published(spark, path) == {(5, 1)}


def test_reads_from_a_day_on_are_pruned(spark, scratch):
    path = f"{scratch}/t"
    publish(dated(spark, *[(m, 1 + m, m) for m in range(1, 9)]), path)
    late = read_published(spark, path, dt.datetime(2020, 7, 2))
    assert {r["v"] for r in late.collect()} == {7, 8}
    scan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in scan and "GreaterThanOrEqual(date" in scan


def test_full_refresh_clears_target(spark, sf_small, scratch):
    raw, job, clock = case(spark, sf_small, "ripple")
    target = os.path.join(scratch, "ripple_full")
    publish(job(raw), target)
    refresh_days(job, raw.where(F.col("closeTime") < 900000000), target, clock=clock, full=True)
    assert last_published_day(spark, target) < dt.datetime(1998, 7, 10)


def test_csv_export_round_trip(spark, sf_small, scratch):
    view = csv_view(QUERIES["cardano_stats"](spark, sf_small), "cardano")
    path = os.path.join(scratch, "cardano_csv")
    write_csv(view, path)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["date"] + [name for _, name in EXPORTS["cardano"]]
    dates = [r["date"] for r in back.collect()]
    assert dates == sorted(dates) and len(dates) == view.count()


def _store(spark, sf, scratch, build):
    path = os.path.join(scratch, f"raw_{build.__name__}")
    build(spark, sf).write.parquet(path)
    return path


RAW = {
    "cardano": L.cardano_blocks, "ripple_payment_xrp": L.ripple_ledgers, "stellar_payment": L.stellar_ledgers,
    "stellar": L.stellar_ledgers, "iota": L.iota_txs, "monero": L.monero_blocks, "nem": L.nem_blocks,
    "neo_outputs": L.neo_blocks, "neo": L.neo_blocks, "lisk": L.lisk_trs, "eos": L.eos_blocks, "waves": L.waves_blocks,
    "tron": L.tron_blocks, "ethereum_tx": L.eth_blocks, "ethereum_actions": L.eth_blocks,
    "ethereum_contract_days": L.eth_blocks, "ethereum_address_days": L.eth_blocks, "ethereum_contracts": L.eth_blocks,
    "ethereum_short_addrs": L.eth_blocks, "ethereum_stats_traced": L.eth_blocks, "ethereum_classic_stats_traced": L.etc_blocks,
}
SAME_AS = {
    "ripple_payment_xrp": "ripple_daily", "stellar_payment": "stellar_payment_stats", "stellar": "stellar_stats", "neo": "neo_stats",
    "ethereum_tx": "eth_tx", "ethereum_actions": "eth_actions", "ethereum_contracts": "eth_contracts",
    "ethereum_short_addrs": "eth_short_addrs", "ethereum_stats_traced": "eth_stats_traced_registry",
    "ethereum_classic_stats_traced": "etc_stats_traced", "cardano": "cardano_stats", "iota": "iota_stats", "monero": "monero_stats",
    "nem": "nem_stats", "lisk": "lisk_stats", "eos": "eos_stats", "waves": "waves_stats", "tron": "tron_stats",
}


def test_each_chain_has_a_case():
    assert set(RAW) == set(CHAINS)


#: One chain of each kind: whole, open days, reading stored tables, several exports, none.
KINDS = ["cardano", "tron", "ripple_payment_xrp", "stellar", "ethereum_tx", "ethereum_contracts", "ethereum_short_addrs", "ethereum_stats_traced"]


@pytest.mark.parametrize("name", KINDS)
def test_refresh_chain_end_to_end(spark, sf_small, scratch, name):
    """Publish, sync row, CSVs: what is published equals the dataset."""
    out, raw = os.path.join(scratch, "out"), _store(spark, sf_small, scratch, RAW[name])
    paths = refresh_chain(spark, name, raw, out)
    assert _rows(read_published(spark, paths["dataset"])) == _rows(QUERIES[SAME_AS[name]](spark, sf_small))
    for ex in CHAINS[name].exports:
        back = spark.read.option("header", True).csv(paths[ex.name])
        assert back.count() > 0 and back.columns[0] == "date"
    if CHAINS[name].sync_view:
        log = spark.read.parquet(paths["sync_log"])
        assert [r["view"] for r in log.collect()] == [CHAINS[name].sync_view]


def test_staging_is_empty_after_a_refresh(spark, sf_small, scratch):
    raw = _store(spark, sf_small, scratch, L.neo_blocks)
    mark = len(staging._staged)
    paths = refresh_chain(spark, "neo", raw, f"{scratch}/out")
    refresh_chain(spark, "neo", raw, f"{scratch}/out")
    assert len(staging._staged) == mark
    assert _rows(read_published(spark, paths["dataset"])) == _rows(QUERIES["neo_stats"](spark, sf_small))
    for name, asset in (("neo_gas", GAS_ASSET_HEX), ("neo_neo", NEO_ASSET_HEX)):
        want = QUERIES["neo_stats"](spark, sf_small).where(F.hex("asset") == asset.upper()).count()
        assert spark.read.option("header", True).csv(paths[name]).count() == want > 0


def test_sync_log_never_runs_ahead(spark, sf_small, scratch, monkeypatch):
    """Blocks that arrive while the job runs are in neither the data nor the log."""
    from daybook.streaming import publishing

    raw = _store(spark, sf_small, scratch, L.cardano_blocks)
    last = spark.read.parquet(raw).agg(F.max("timeIssued")).first()[0]
    real = publishing.publish

    def late(df, path, **kw):
        spark.read.parquet(raw).limit(1).withColumn("timeIssued", F.lit(last + 10**6)).write.mode("append").parquet(raw)
        real(df, path, **kw)

    monkeypatch.setattr(publishing, "publish", late)
    paths = refresh_chain(spark, "cardano", raw, f"{scratch}/out")
    row = spark.read.parquet(paths["sync_log"]).first()
    assert row["sync_time"] == dt.datetime(1970, 1, 1) + dt.timedelta(seconds=last)


def test_erc20_export_per_symbol(spark, sf_small, scratch):
    import json

    from daybook.sources.tokens import TOKENS
    from daybook.streaming.publishing import export_erc20

    raw = _store(spark, sf_small, scratch, L.eth_blocks)
    tokens = os.path.join(scratch, "tokens.json")
    with open(tokens, "w") as f:
        json.dump([{"contractAddress": a, "name": n, "symbol": s, "decimals": d} for a, n, s, d in TOKENS], f)
    path = export_erc20(spark, raw, tokens, f"{scratch}/out")
    symbols = {p.split("=", 1)[1] for p in os.listdir(path) if p.startswith("symbol=")}
    view = QUERIES["csv_erc20"](spark, sf_small)
    assert symbols == {r["symbol"] for r in view.select("symbol").distinct().collect()}
    assert spark.read.option("header", True).csv(path).count() == view.count()


def test_staging_refuses_local_cluster():
    from daybook.session import ensure_checkpoint_dir

    class Context:
        master = "local-cluster[2,1,1024]"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session)
