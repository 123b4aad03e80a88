"""What grows with the ledger is shuffled, stored and built once."""

import datetime as dt
import os
import re
from decimal import Decimal as D

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from daybook.functions import wide
from daybook.operators.staging import frozen
from daybook.plans import ethereum, utxo
from daybook.plans.catalog import QUERIES
from daybook.session import BLOCK_CONF, BLOCK_OPTIONS, few_blocks
from daybook.sources import ledgers as L


def test_lineitems_are_placed_by_order_once(spark, sf_small):
    per_order = L.lineitems(spark, sf_small).groupBy("k").agg(F.collect_list("idx").alias("idx"))
    plan = per_order._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize(
    "query",
    ["etc_stats", "eth_stats_traced", "etc_stats_traced", "eth_stats_traced_registry", "neo_stats", "cardano_stats"],
)
def test_the_ledger_is_built_once(spark, sf_small, query):
    """What a job reads several times is a stored ledger, not the plan that builds it."""
    assert not [f for f in QUERIES[query](spark, sf_small).inputFiles() if "lineitem" in f or "orders" in f]


def _neo_blocks(spark):
    tx = "array<struct<txid:bigint,sys_fee:decimal(38,8),net_fee:decimal(38,8),vin:array<struct<txid:bigint,vout:int>>,vout:array<struct<asset:binary,value:decimal(38,8),address:string>>>>"
    a, none = bytearray(b"a"), None

    def of(txid, vin, *vout):
        return (txid, 1, 0, vin, [(asset, value, address) for asset, value, address in vout])

    rows = [
        (0, 0, [of(1, [], (a, 5, "x"), (a, 7, "y"), (none, 1, "x")), of(2, [(1, 0)], (a, 2, "x"), (a, 3, None))]),
        (1, 600, [of(3, [(1, 1), (1, 2)], (a, 7, "y"), (none, 1, "z")), of(3, [], (a, 4, "w"))]),
        (2, 90000, [of(4, [], (a, 9, "x"))]),
    ]
    rows = [(i, t, [(k, D(s), D(n), v, [(b, D(x), p) for b, x, p in o]) for k, s, n, v, o in txs]) for i, t, txs in rows]
    return spark.createDataFrame(rows, f"index bigint, time bigint, tx {tx}")


def test_neo_days_out_of_one_shuffle_by_address(spark, monkeypatch):
    """Each address of a day counts once, whatever its transactions; only what the day needs is stored."""
    stored = []

    def noted(df, stage=utxo.stage):
        stored.append(df.columns)
        return stage(df)

    monkeypatch.setattr(utxo, "stage", noted)
    out = utxo.neo_stats(_neo_blocks(spark)).drop("date").collect()
    assert [(bytes(r["asset"]), r["cnt"], r["value"], r["med_value"], r["from_cnt"], r["to_cnt"], r["addr_cnt"]) for r in out] == [
        (b"a", 6, 5 + 7 + 0 + 3 + 0 + 4, 3.5, 2, 3, 3)
    ]
    assert not [c for c in stored if "txid" in c]


@pytest.mark.parametrize("build", [L.cardano_blocks, L.monero_blocks, L.neo_blocks])
def test_utxo_blocks_out_of_one_placement(spark, sf_small, build):
    """Order keys are counted, then orders and lineitems are shuffled together, once; nothing is joined."""
    plan = build(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan


def test_utxo_orders_that_repeat_lack_or_cross(spark, tmp_path):
    """Repeated, absent and NULL orders, and spends over the border of two stretches."""
    orders, at = [998, 999, 1000, 1000, 1003, 2001, None], dt.datetime(1995, 1, 1)
    items = [(k, i) for k in (997, 999, 1000, 1002, 2000, None) for i in range(3)]
    spark.createDataFrame([(k,) for k in orders], "o_orderkey bigint").write.parquet(f"{tmp_path}/orders.parquet")
    rows = [(k, i, 7, i, 1.0, float(i), 0.0, 0.0, "N", "O", at) for k, i in items]
    names = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = L.cardano_blocks(spark, str(tmp_path)).select("timeIssued", F.explode("transactions").alias("t"))
    got = sorted((r[0], r[1]["id"], [int(i["value"]) for i in r[1]["inputs"]], [int(i["value"]) for i in r[1]["outputs"]]) for r in got.where("t.id IS NOT NULL").collect())
    have = {k for k, _ in items if k is not None}
    assert got == sorted(
        (L.DAY0_EPOCH + k // 10 * 6000, k, [0, 200] if k - 1 in have else [], [0, 100, 200] if k in have else [])
        for k in orders if k is not None
    )
    (none,) = L.cardano_blocks(spark, str(tmp_path)).where("timeIssued IS NULL").collect()
    assert [(t["id"], t["inputs"], t["outputs"]) for t in none["transactions"]] == [(None, [], [])]


def test_largest_number_without_sorting_rows(spark):
    """The largest of any numbers by their upper and lower digits, rows met by hash aggregates alone."""
    numbers = [0, 5, 10**9, 10**18 + 3, 10**27 + 1, 10**36 - 1, 10**36, 10**36 + 2, 10**45, 2**256 - 2, 2**256 - 1]
    limbs = [F.col(f"l{k}") for k in range(9)]
    rows = [(g, *[n // 10 ** (9 * k) % 10**9 for k in range(9)]) for g in range(len(numbers)) for n in numbers[: g + 1]]
    rows += [(-1, *[None] * 9), (0, *[None] * 9)]
    df = spark.createDataFrame(rows, "g int, " + ", ".join(f"l{k} bigint" for k in range(9)))
    first = df.groupBy("g", wide.upper(limbs).alias("up")).agg(F.max(wide.lower(limbs)).alias("low"))
    assert "SortAggregate" not in first._jdf.queryExecution().executedPlan().toString()
    top = first.groupBy("g").agg(F.max(wide.rejoined(F.col("up"), F.col("low"))).alias("top"))
    got = {r[0]: r[1] for r in top.select("g", wide.rejoined_digits(F.col("top"))).collect()}
    assert got.pop(-1) is None
    assert {g: int(d) for g, d in got.items()} == dict(enumerate(numbers))


def test_token_transfers_are_not_sorted_for_their_largest(spark, sf_small):
    """What Spark must sort for a maximum are groups of equal upper digits, not transfers or addresses."""
    spark.conf.set("daybook.stage", "none")
    try:
        plan = QUERIES["erc20_transfers"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("daybook.stage")
    assert "SortAggregate" in plan and "struct(l" not in plan


def test_few_blocks_are_read_at_a_time(spark):
    """Parquet batches are bounded by rows alone, and a row may be a block of many thousand transactions."""
    from daybook.session import configure

    assert int(configure(spark).conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 128


def _scanned(df):
    """What the first scan of ``df`` reads."""
    return df._jdf.queryExecution().sparkPlan().collectLeaves().head().requiredSchema().simpleString()


def test_transactions_of_a_stored_ledger_are_read_by_field(spark, sf_small):
    """Logs and actions, most of a block, are not read for its transactions or for their number."""
    blocks = frozen(L.eth_blocks(spark, sf_small)).where("timestamp > 0")
    for df in (ethereum.tx_units(blocks), ethereum.address_totals(blocks), ethereum._block_stats(blocks, "eth")):
        assert "from" in _scanned(df) and not re.search(r"\b(logs|actions)\b", _scanned(df))


def test_transactions_that_lack(spark):
    """Blocks with NULL or no transactions give no rows, a NULL transaction gives a row of NULLs; only items are counted."""
    kind = "from bigint, to bigint, contractAddress bigint, value decimal(38,0), gasUsed bigint, gasPrice decimal(38,0)"
    kind = f"array<struct<{kind.replace(' ', ':').replace(',:', ',')}>>"
    full = (1, None, 7, D(5), 21000, D(2))
    rows = [(n, 86400, D(1), 10, [], t) for n, t in enumerate([None, [], [full, None], [full]])]
    names = "number bigint, timestamp bigint, difficulty decimal(38,0), size bigint, uncles array<struct<number:bigint>>, transactions "
    blocks = spark.createDataFrame(rows, names + kind)
    got = sorted((tuple(r)[2:] for r in ethereum.tx_units(blocks).collect()), key=str)
    assert got == [(1, None, 7, D(5), D(42000)), (1, None, 7, D(5), D(42000)), (None,) * 5]
    (day,) = ethereum._block_stats(blocks, "eth").collect()
    assert (day["block_cnt"], day["sum_size"], day["avg_tx_size"]) == (4, 40, 40 / 3)


def test_blocks_are_stored_by_their_bytes(spark):
    """A row group ends by its bytes; left alone, Parquet buffers a hundred rows of any size."""
    rows = spark.createDataFrame([(i, [os.urandom(1 << 18) for _ in range(4)]) for i in range(40)], "i int, b array<binary>").coalesce(1)
    for options, most in ((BLOCK_OPTIONS, 20), ({}, 100)):
        (file,) = frozen(rows, **options).inputFiles()
        meta = pq.read_metadata(file.removeprefix("file:"))
        assert max(meta.row_group(k).num_rows for k in range(meta.num_row_groups)) <= most
        assert (meta.num_row_groups > 1) == bool(options)


def _settings(spark):
    return {key: spark.conf.get(key) for key in BLOCK_CONF}


def test_traced_refresh_holds_few_blocks(spark, sf_small, monkeypatch):
    """Each step that stores or reads the ledger runs with the settings for large blocks, which end with the query."""
    seen, before = [], _settings(spark)

    def noted(fn):
        def run(blocks, *args, **kw):
            seen.append(_settings(blocks.sparkSession))
            return fn(blocks, *args, **kw)

        return run

    for name in ("contract_days", "eth_stats_traced"):
        monkeypatch.setattr(ethereum, name, noted(getattr(ethereum, name)))
    assert QUERIES["eth_stats_traced_refreshed"](spark, sf_small).count() > 0
    assert len(seen) == 4 and all(s == BLOCK_CONF for s in seen)
    assert _settings(spark) == before != BLOCK_CONF


def test_settings_for_large_blocks_end_with_an_error(spark):
    before = _settings(spark)
    with pytest.raises(ZeroDivisionError), few_blocks(spark):
        assert _settings(spark) == BLOCK_CONF
        1 / 0
    assert _settings(spark) == before


@pytest.mark.parametrize("query, job", [("csv_erc20_files", "erc20_transfers"), ("eth_stats_traced_refreshed", "contract_days")])
def test_stored_blocks_end_row_groups_by_their_bytes(spark, sf_small, monkeypatch, query, job):
    """The job reads a ledger stored with the options for large blocks, block by block."""
    seen = []

    def noted(blocks, *args, fn=getattr(ethereum, job), **kw):
        seen.append(_settings(spark))
        for file in blocks.inputFiles():
            meta = pq.read_metadata(file.removeprefix("file:"))
            seen.append(_settings(spark) if meta.num_row_groups > 1 or meta.num_rows < 70 else file)
        return fn(blocks, *args, **kw)

    monkeypatch.setattr(ethereum, job, noted)
    monkeypatch.setitem(BLOCK_OPTIONS, "parquet.block.size", "4096")
    assert QUERIES[query](spark, sf_small).count() > 0
    assert len(seen) > 1 and all(s == BLOCK_CONF for s in seen)
    assert _settings(spark) != BLOCK_CONF
