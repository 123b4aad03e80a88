"""Plan checks on whole job plans (nothing staged): no Python, pruning and
bounds that reach the scan, few scans and exchanges."""

import datetime as dt
import re

import pytest

from daybook.plans.catalog import QUERIES
from daybook.sources import ledgers as L
from daybook.sources.schemas import FIELDS, read_for
from daybook.streaming import Clock, open_days


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def unstaged(spark):
    """Jobs as one lazy plan, printed in full."""
    spark.conf.set("daybook.stage", "none")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    yield
    spark.conf.unset("daybook.stage")
    spark.conf.unset("spark.sql.maxMetadataStringLength")


CHAIN_TABLES = {
    "tron_stats": L.tron_blocks, "eos_stats": L.eos_blocks, "lisk_stats": L.lisk_trs, "nem_stats": L.nem_blocks,
    "waves_stats": L.waves_blocks, "ripple_payment_stats": L.ripple_ledgers, "ripple_daily": L.ripple_ledgers,
    "stellar_payment_stats": L.stellar_ledgers, "stellar_stats": L.stellar_ledgers, "cardano_stats": L.cardano_blocks,
    "monero_stats": L.monero_blocks, "neo_stats": L.neo_blocks, "iota_stats": L.iota_txs, "eth_tx": L.eth_blocks,
    "eth_actions": L.eth_blocks, "eth_contracts": L.eth_blocks, "eth_short_addrs": L.eth_blocks,
    "eth_short_tx": L.eth_blocks, "etc_stats": L.etc_blocks, "eth_stats_traced": L.eth_blocks, "erc20_transfers": L.eth_blocks,
}

#: Most parquet scans and exchanges of a job's whole plan.
LIMITS = {
    "tron_stats": (5, 16), "eos_stats": (5, 16), "nem_stats": (4, 16), "ripple_daily": (9, 22), "iota_stats": (5, 18),
    "eth_short_tx": (1, 3), "eth_short_addrs": (1, 2), "neo_stats": (14, 44), "erc20_transfers": (5, 18),
}


def job(name):
    from daybook.plans import account, bundle, ethereum, ledger, tron, utxo

    for module in (account, bundle, ethereum, ledger, tron, utxo):
        if hasattr(module, name):
            return getattr(module, name)


def run(spark, name, raw):
    if name == "erc20_transfers":
        from daybook.sources.tokens import token_frame

        return job(name)(raw, token_frame(spark))
    return job(name)(raw)


@pytest.fixture(scope="module")
def stored(spark, sf_small, tmp_path_factory):
    """Raw chain tables as stored, each written once."""
    root, paths = tmp_path_factory.mktemp("raw"), {}
    for build in {id(b): b for b in CHAIN_TABLES.values()}.values():
        paths[build] = f"{root}/{build.__name__}"
        build(spark, sf_small).write.parquet(paths[build])
    return paths


@pytest.mark.parametrize("name", sorted(CHAIN_TABLES))
def test_whole_plan(spark, stored, unstaged, name):
    plan = plan_of(run(spark, name, read_for(spark, stored[CHAIN_TABLES[name]], name)))
    for node in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan
    scans, exchanges = plan.count("FileScan parquet"), len(re.findall(r"\bExchange ", plan))
    assert scans >= 1
    if name in LIMITS:
        assert scans <= LIMITS[name][0] and exchanges <= LIMITS[name][1], (scans, exchanges)
    if name in ("nem_stats", "neo_stats", "erc20_transfers"):
        assert "Expand" not in plan  # no distinct aggregates side by side


def test_older_files_lack_a_field(spark, tmp_path):
    """NULL where a file lacks a nested field, whichever file the schema comes from; still narrow; unknown fields are refused."""
    from daybook.sources import schemas

    path, kind = str(tmp_path / "t"), "timestamp bigint, transactions array<struct<{}>>"
    spark.createDataFrame([(1, [(4, 7)])], kind.format("type:int,fee:bigint")).write.parquet(path)
    spark.createDataFrame([(2, [(11, 8, [("a", 5)], "x")])], kind.format("type:int,fee:bigint,transfers:array<struct<recipient:string,amount:bigint>>,memo:string")).write.mode("append").parquet(path)
    keep = {"timestamp": None, "transactions": {"type": None, "transfers": {"amount": None}}}
    schemas.FIELDS["grown"] = keep
    try:
        got = read_for(spark, path, "grown")
        rows = {r["timestamp"]: r["transactions"][0] for r in got.collect()}
        assert rows[1]["transfers"] is None and rows[2]["transfers"][0]["amount"] == 5
        (schema,) = re.findall(r"ReadSchema: (.*)", plan_of(got))
        assert "memo" not in schema and "fee" not in schema and "recipient" not in schema
        keep["transactions"]["never"] = None
        with pytest.raises(ValueError, match="never"):
            read_for(spark, path, "grown")
    finally:
        del schemas.FIELDS["grown"]


@pytest.mark.parametrize("name", sorted(CHAIN_TABLES))
def test_read_schema_is_narrow(spark, stored, unstaged, name):
    """The scan of a job reads no field outside its narrow schema."""
    raw = read_for(spark, stored[CHAIN_TABLES[name]], name)

    def names(tree):
        return {n for n in tree} | {x for sub in tree.values() if sub for x in names(sub)}

    allowed = names(FIELDS[name]) | {"array", "struct", "element"}
    for schema in re.findall(r"ReadSchema: struct<(.*)>", plan_of(run(spark, name, raw))):
        assert set(re.findall(r"([A-Za-z_0-9]+):", schema)) <= allowed


def test_traced_jobs_never_read_logs(spark, stored, unstaged):
    raw = read_for(spark, stored[L.eth_blocks], "eth_stats_traced")
    assert "logs" not in plan_of(run(spark, "eth_stats_traced", raw))
    raw = read_for(spark, stored[L.eth_blocks], "erc20_transfers")
    assert not re.search(r"\bactions\b", plan_of(run(spark, "erc20_transfers", raw)))


CUT = dt.datetime(1998, 7, 1)
BOUND = int((CUT - dt.datetime(1970, 1, 1)).total_seconds())


def test_refresh_bound_reaches_the_scan(spark, stored, unstaged):
    """The plan that refresh_days publishes holds a bound on the raw clock in each scan."""
    from daybook.plans import ethereum, ledger, utxo

    outputs = utxo.neo_outputs(read_for(spark, stored[L.neo_blocks], "neo_stats"))
    cases = [
        (lambda r, since=None: ledger.ripple_daily(r), L.ripple_ledgers, "ripple_daily", "closeTime"),
        (lambda r, since=None: ethereum.eth_tx(r), L.eth_blocks, "eth_tx", "timestamp"),
        (lambda r, since=None: utxo.neo_outputs(r), L.neo_blocks, "neo_stats", "time"),
    ]
    for fn, build, schema, clock in cases:
        plan = plan_of(open_days(fn, read_for(spark, stored[build], schema), Clock(clock), CUT))
        pushed = re.findall(r"PushedFilters: \[(.*?)\]", plan)
        assert pushed and all(f"GreaterThanOrEqual({clock},{BOUND})" in p for p in pushed)
    neo = plan_of(open_days(lambda r, since=None: utxo.neo_stats(r, since, outputs), read_for(spark, stored[L.neo_blocks], "neo_stats"), Clock("time"), CUT))
    assert f"GreaterThanOrEqual(time,{BOUND})" in neo


def test_refresh_prunes_day_partitions(spark, sf_small, unstaged, scratch):
    from daybook.functions import day_of_seconds, day_text
    from daybook.plans.ledger import ripple_daily

    raw = f"{scratch}/ripple_raw"
    L.ripple_ledgers(spark, sf_small).withColumn("day", day_text(day_of_seconds("closeTime"))).write.partitionBy("day").parquet(raw)
    plan = plan_of(open_days(lambda r, since=None: ripple_daily(r), read_for(spark, raw, "ripple_daily"), Clock("closeTime"), CUT))
    filters = re.findall(r"PartitionFilters: \[(.*?)\]", plan)
    assert filters and all("day" in f and "1998-07-01" in f for f in filters)


def test_fixture_scan_reads_only_needed_columns(spark, sf_small, unstaged):
    scans = [line for line in plan_of(QUERIES["tron_stats"](spark, sf_small)).splitlines() if "FileScan parquet" in line and "lineitem" in line]
    assert scans and all(len(re.findall("ReadSchema", line)) == 1 for line in scans)
