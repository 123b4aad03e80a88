"""Nested chain ledgers built from the supplied TPC-H-style tables.

No chain data ships with the tests, so each chain's nested block table is
derived by fixed rules (FIXTURES.md §3) from ``orders``, ``lineitem`` and
``events``.  Everything is a lazy Spark plan: the work grows with the input
tables, and nothing passes through the driver.

Account ledger: one order is one transaction (sender ``o_custkey``,
receiver ``(o_orderkey * 7) % 1000`` or NULL for '5-LOW', value in cents),
its lineitems are its operations.  Block number is (days since 1995-01-01)
× 4 + ``o_orderkey % 4``; the block closes at midnight + 6 h × slot.

UTXO ledger: the outputs of order k are its lineitems, numbered from 0 in
a fixed order; order k spends the even-numbered outputs of order k − 1.

Bundle ledger: events grouped four to a bundle, with reattachments, and
bundles that declare one more entry than they hold (incomplete).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from daybook.functions.clock import floor_div
from daybook.sources import tokens as token_list
from daybook.sources.exports import GAS_ASSET_HEX, NEO_ASSET_HEX

DAY0_UNIX_DATE = 9131  # 1995-01-01
DAY0_EPOCH = DAY0_UNIX_DATE * 86400
SHORT_BASE = 10**9  # address range of the fee-free relay used by short-lived-address checks
# Topic 0 of an ERC20 Transfer event (keccak of
# "Transfer(address,address,uint256)"); the Approval topic marks logs the
# token job must skip.
TRANSFER_TOPIC = "ddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
APPROVAL_TOPIC = "8c5be1e5ebec7d5bd14f71427d1e84f3dd0314c0f7b2291e5b200ac8c7c3b925"
ETH_NUMBER_OFFSET = 4_365_000  # puts the 4,370,000 reward change inside the data
ETC_NUMBER_OFFSET = 4_995_000  # puts the 5,000,000 era change inside the data

D38 = DecimalType(38, 0)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with the account-ledger fields.

    Block number is (days since 1995-01-01) × 4 + k % 4 at every size.
    """
    o = _read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    unix_day = F.unix_date(F.to_date("o_orderdate")).cast("long")
    return o.select(
        k.alias("k"),
        F.col("o_custkey").alias("cust"),
        F.when(F.col("o_orderpriority") != "5-LOW", (k * 7) % 1000).alias("recv"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("val"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("prio"),
        ((unix_day - DAY0_UNIX_DATE) * 4 + k % 4).alias("num"),
        (unix_day * 86400 + (k % 4) * 21600).alias("btime"),
    )


def lineitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem, numbered from 0 within its order by all columns.

    The given line number is not unique, so ``idx`` comes from a window over
    one order's lineitems (a handful of rows per window partition).
    """
    # Named before the window: joins and groups by ``k`` that follow then find the
    # lineitems placed by it, and each column goes through the window's shuffle once.
    li = _lineitem(spark, sf_dir)
    return _numbered(li, li.columns, ["k"])


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "k").where("k IS NOT NULL")


def _numbered(li: DataFrame, columns: list[str], within: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Lineitems numbered from 0 by ``columns`` within ``within``, with the columns the ledgers use."""
    order = Window.partitionBy(*within).orderBy(*[F.col(c) for c in columns])
    return li.withColumn("_row", F.row_number().over(order)).select(
        *keep,
        "k",
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supp"),
        F.col("l_linenumber").alias("lnum"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("lstatus"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("amt"),
        (F.col("_row") - 1).alias("idx"),
    )


def _blocks(txs: DataFrame, block_cols: list, tx_field: str = "transactions", extra: dict | None = None) -> DataFrame:
    """Group per-transaction structs into one row per block."""
    aggs = [F.collect_list("tx").alias(tx_field)]
    out = txs.groupBy(*block_cols).agg(*aggs)
    for name, expr in (extra or {}).items():
        out = out.withColumn(name, expr)
    return out


def _with_items(spark, sf_dir, item_struct, name: str) -> DataFrame:
    """Orders joined to an array of per-lineitem structs (NULL when none)."""
    li = lineitems(spark, sf_dir).join(orders(spark, sf_dir).select("k", "cust", "prio", "recv"), "k")
    items = li.groupBy("k").agg(F.collect_list(item_struct).alias(name))
    return orders(spark, sf_dir).join(items, "k", "left")


# ---------------------------------------------------------------- Tron
def tron_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract = F.struct(
        F.when(F.col("flag") == "R", "TriggerSmartContract").otherwise("TransferContract").alias("type"),
        F.col("cust").alias("owner_address"),
        F.col("supp").alias("to_address"),
        F.col("amt").alias("amount"),
    )
    o = _with_items(spark, sf_dir, contract, "contracts")
    txs = o.select("num", "btime", F.struct("contracts").alias("tx"))
    b = _blocks(txs, ["num", "btime"])
    return b.select(F.col("num").alias("number"), (F.col("btime") * 1000).alias("timestamp"), "transactions")


# ----------------------------------------------------------------- EOS
def _hex8(c):
    return F.lpad(F.hex(c), 16, "0")


def _hex8_le(c):
    h = F.lpad(F.hex(c), 16, "0")
    return F.concat(*[F.substring(h, 15 - 2 * i, 2) for i in range(8)])


def eos_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    symbol = F.when(F.col("part") % 4 == 0, "SYS").otherwise("EOS")
    payload = F.unhex(
        F.concat(
            _hex8(F.col("cust")),
            _hex8(F.col("supp")),
            _hex8_le(F.col("amt")),
            F.lit("04"),
            F.rpad(F.hex(symbol), 14, "0"),
        )
    )
    action = F.struct(
        F.when(F.col("flag") == "R", "eosio.other").otherwise("eosio.token").alias("account"),
        F.when(F.col("part") % 9 == 0, "issue").otherwise("transfer").alias("name"),
        payload.alias("data"),
    )
    o = _with_items(spark, sf_dir, action, "actions")
    tx = F.struct(F.when(F.col("status") == "P", "hard_fail").otherwise("executed").alias("status"), "actions")
    b = _blocks(o.select("num", "btime", tx.alias("tx")), ["num", "btime"])
    return b.select(F.col("btime").alias("timestamp"), "transactions")


# ----------------------------------------------------- Ethereum
def _pad32(c):
    return F.concat(F.lit(bytes(24)), F.unhex(F.lpad(F.hex(c), 16, "0")))


#: Addresses of the fixed token list, by list position.
_TOKEN_ADDRESSES = [bytes.fromhex(address[2:]) for address, *_ in token_list.TOKENS]


def _eth_log(item):
    """The event log of one lineitem."""
    topic0 = F.when(item["approval"], F.lit(bytes.fromhex(APPROVAL_TOPIC))).otherwise(F.lit(bytes.fromhex(TRANSFER_TOPIC)))
    data = F.when(item["wild"], F.lit(bytes([255] * 32))).otherwise(_pad32(item["amt"]))
    return F.struct(
        F.get(F.array(*[F.lit(a) for a in _TOKEN_ADDRESSES]), item["token"]).alias("address"),
        data.alias("data"),
        F.array(topic0, _pad32(item["cust"]), _pad32(item["supp"])).alias("topics"),
    )


def _eth_action(k, item):
    """The traced action of one lineitem of order ``k``."""
    return F.struct(
        item["cust"].alias("from"),
        F.when(item["creates"], k).otherwise(item["supp"]).alias("to"),
        item["amt"].cast(D38).alias("value"),
        F.when(item["creates"], 1).otherwise(0).alias("type"),
        item["accounted"].alias("accounted"),
    )


def _eth_transaction(x):
    """A transaction out of its order's fields and lineitems, which are shuffled in its stead: they are a fraction of it."""
    k, t = x["k"], x["t"]
    return F.struct(
        t["from"].alias("from"),
        t["to"].alias("to"),
        F.when(t["creating"], k).alias("contractAddress"),
        t["val"].cast(D38).alias("value"),
        F.lit(21000).cast("long").alias("gasUsed"),
        F.when(x["seq"] == 0, k % 50 + 1).otherwise(0).cast(D38).alias("gasPrice"),
        F.transform(t["items"], _eth_log).alias("logs"),
        F.transform(t["items"], lambda item: _eth_action(k, item)).alias("actions"),
    )


def eth_blocks(spark: SparkSession, sf_dir: str, number_offset: int = ETH_NUMBER_OFFSET) -> DataFrame:
    """Ethereum-style blocks: transactions with logs (token transfers) and traced actions."""
    creating = F.col("prio") == "5-LOW"
    li = lineitems(spark, sf_dir).join(orders(spark, sf_dir).select("k", "cust", "prio"), "k")
    token = F.col("part") % token_list.COUNT
    item = F.struct(
        token.cast("int").alias("token"),
        (F.col("part") % 101 == 0).alias("wild"),
        ((F.col("lstatus") == "F") & (F.col("flag") == "R")).alias("approval"),
        (creating & (F.col("idx") == 0)).alias("creates"),
        (F.col("flag") != "R").alias("accounted"),
        "cust",
        "supp",
        "amt",
    )
    per_tx = li.where(token >= 0).groupBy("k").agg(F.collect_list(item).alias("items"))
    main = orders(spark, sf_dir).join(per_tx, "k", "left").select(
        "num",
        "btime",
        "k",
        F.lit(0).alias("seq"),
        F.col("cust").alias("from"),
        F.col("recv").alias("to"),
        creating.alias("creating"),
        "val",
        "items",
    )
    relay = orders(spark, sf_dir).where(F.col("k") % 20 == 0)
    hop = F.explode(F.array(F.lit(1), F.lit(2))).alias("seq")
    relay = relay.select("num", "btime", "k", "cust", "val", hop)
    relay = relay.select(
        "num",
        "btime",
        "k",
        "seq",
        F.when(F.col("seq") == 1, F.col("cust")).otherwise(F.col("k") + SHORT_BASE).alias("from"),
        F.when(F.col("seq") == 1, F.col("k") + SHORT_BASE).otherwise((F.col("k") * 7) % 1000).alias("to"),
        F.lit(False).alias("creating"),
        "val",
        F.lit(None).cast(per_tx.schema["items"].dataType).alias("items"),
    )
    none = F.array().cast(per_tx.schema["items"].dataType)
    t = F.struct("from", "to", "creating", "val", F.coalesce("items", none).alias("items"))
    b = main.unionByName(relay).groupBy("num", "btime").agg(
        F.sort_array(F.collect_list(F.struct("k", "seq", t.alias("t")))).alias("_txs")
    )
    number = F.col("num") + F.lit(number_offset)
    return b.select(
        number.alias("number"),
        F.col("btime").alias("timestamp"),
        (number % 1000 + 1).cast(D38).alias("difficulty"),
        (F.size("_txs") * 1000).cast("long").alias("size"),
        F.when(number % 7 == 0, F.array(F.struct((number - 1).alias("number")))).otherwise(
            F.array().cast("array<struct<number:bigint>>")
        ).alias("uncles"),
        F.transform("_txs", _eth_transaction).alias("transactions"),
    )


def etc_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eth_blocks(spark, sf_dir, ETC_NUMBER_OFFSET)


# ------------------------------------------------------------- UTXO chains
#: Orders whose blocks are placed together, with their lineitems.
_STRETCH = 1000


def _utxo_blocks(spark: SparkSession, sf_dir: str, orders_per_block: int, transaction, tx_field: str = "transactions") -> DataFrame:
    """(blk, tx_field): orders grouped to blocks, each then written out as ``transaction``.

    Orders and lineitems are placed once, by stretches of blocks; lineitems whose
    next order lies in another stretch go there too.  There they are numbered, meet
    their own order and the next one, which spends them, and make up its block.
    ``transaction`` runs on the finished blocks: the bare orders are a fraction of it.
    """

    def block(k):
        return (k / orders_per_block).cast("long")

    def stretch(k):
        return floor_div(block(k), _STRETCH // orders_per_block)

    li = _lineitem(spark, sf_dir)
    k = F.col("k")
    li = li.withColumn("stretch", F.explode(F.array_distinct(F.array(stretch(k), stretch(k + 1)))))
    o = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    o = o.groupBy("k").agg(F.count(F.lit(1)).alias("times")).withColumn("stretch", stretch(k))
    rows = li.withColumn("times", F.lit(0).cast("long")).unionByName(o, allowMissingColumns=True).repartition("stretch")
    address = F.when((F.col("idx") == 0) & (F.col("k") % 20 == 0), F.col("k") + SHORT_BASE).otherwise(F.col("supp"))
    rows = _numbered(rows, li.columns, ["stretch", "k", "times"], keep=("stretch", "times"))
    item = F.when(F.col("times") == 0, F.struct("idx", "flag", "amt", address.alias("address")))
    per = rows.groupBy("stretch", "k").agg(F.sum("times").alias("times"), F.sort_array(F.collect_list(item)).alias("outs"))
    before = Window.partitionBy("stretch").orderBy("k")
    spent = F.filter(F.lag("outs").over(before), lambda i: i["idx"] % 2 == 0)
    per = per.withColumn("ins", F.when(F.lag("k").over(before) == k - 1, spent))
    none = F.array().cast(per.schema["outs"].dataType)
    t = F.struct("k", "outs", F.coalesce("ins", none).alias("ins"))
    txs = per.where("times > 0").select("stretch", block(k).alias("blk"), F.explode(F.array_repeat(t, F.col("times").cast("int"))).alias("tx"))
    b = _blocks(txs, ["stretch", "blk"], tx_field).drop("stretch")
    return b.withColumn(tx_field, F.transform(tx_field, transaction))


def cardano_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    def item(i):
        return F.struct(i["address"].alias("address"), i["amt"].cast(D38).alias("value"))

    def transaction(t):
        return F.struct(
            t["k"].alias("id"),
            (F.lit(DAY0_EPOCH) + t["k"] * 600).alias("timeIssued"),
            F.transform(t["ins"], item).alias("inputs"),
            F.transform(t["outs"], item).alias("outputs"),
        )

    b = _utxo_blocks(spark, sf_dir, 10, transaction)
    return b.select((F.lit(DAY0_EPOCH) + F.col("blk") * 6000).alias("timeIssued"), "transactions")


def monero_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    def item(i):
        return F.struct(i["amt"].cast(D38).alias("amount"))

    def transaction(t):
        return F.struct(
            t["k"].alias("hash"),
            ((t["k"] % 50 + 1) * 100000000).cast(D38).alias("fee"),
            F.transform(t["ins"], item).alias("vin"),
            F.transform(t["outs"], item).alias("vout"),
        )

    b = _utxo_blocks(spark, sf_dir, 2, transaction)
    height = F.col("blk") + 1220000
    return b.select(
        height.alias("height"),
        (F.lit(DAY0_EPOCH) + F.col("blk") * 1200).alias("timestamp"),
        (F.size("transactions") * 1000).cast("long").alias("size"),
        ((height % 5 + 1) * 600000000000).cast(D38).alias("reward"),
        (height % 1000 + 1).cast(D38).alias("difficulty"),
        "transactions",
    )


NEO_VALUE = DecimalType(38, 8)


def neo_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    def output(i):
        # Return flag N pays in NEO and A in GAS, under their ids on the chain; R in a third asset.
        asset = F.when(i["flag"] == "N", F.lit(NEO_ASSET_HEX)).when(i["flag"] == "A", F.lit(GAS_ASSET_HEX)).otherwise(F.lit("ab" * 32))
        return F.struct(
            F.unhex(asset).alias("asset"),
            (i["amt"].cast(NEO_VALUE) / 100).cast(NEO_VALUE).alias("value"),
            F.concat(F.lit("A"), i["address"].cast("string")).alias("address"),
        )

    def transaction(t):
        return F.struct(
            t["k"].alias("txid"),
            (t["k"] % 3).cast(NEO_VALUE).alias("sys_fee"),
            ((t["k"] % 50 + 1).cast(NEO_VALUE) / 1000).cast(NEO_VALUE).alias("net_fee"),
            F.transform(t["ins"], lambda i: F.struct((t["k"] - 1).alias("txid"), i["idx"].cast("int").alias("vout"))).alias("vin"),
            F.transform(t["outs"], output).alias("vout"),
        )

    b = _utxo_blocks(spark, sf_dir, 2, transaction, "tx")
    return b.select(F.col("blk").alias("index"), (F.lit(DAY0_EPOCH) + F.col("blk") * 1200).alias("time"), "tx")


# ------------------------------------------------------- flat-table chains
def iota_txs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events")
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    bundle = (F.col("event_id") / 4).cast("long")
    cents = F.round(F.col("value") * 100).cast("long")
    base = e.select(
        bundle.alias("bundle"),
        (F.col("event_id") % 4).alias("currentIndex"),
        # every 17th bundle declares a fifth entry it never gets: incomplete
        F.when(bundle % 17 == 0, F.lit(4)).otherwise(F.lit(3)).cast("long").alias("lastIndex"),
        F.when(bundle % 2 == 0, floor_div(micros, 1000)).otherwise(floor_div(micros, 1000000)).alias("timestamp"),
        F.when(F.col("event_type").isin("click", "purchase"), cents)
        .when(F.col("event_type") == "error", -cents)
        .otherwise(F.lit(0).cast("long"))
        .alias("value"),
        F.concat(F.lit("A"), F.col("user_id").cast("string")).alias("address"),
        F.col("event_id"),
        F.col("user_id"),
    )
    again = base.where(F.col("event_id") % 10 == 0).withColumn(
        "address", F.concat(F.lit("A"), (F.col("user_id") + 1000000).cast("string"))
    )
    return base.unionByName(again).drop("event_id", "user_id")


def lisk_trs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.functions.clock import LISK_GENESIS

    o = orders(spark, sf_dir)
    return o.select(
        (F.col("btime") - LISK_GENESIS).alias("timestamp"),
        (F.col("k") % 4).cast("int").alias("type"),
        F.col("val").alias("amount"),
        ((F.col("k") % 50 + 1) * 100000).alias("fee"),
        F.concat(F.col("cust").cast("string"), F.lit("L")).alias("senderId"),
        F.concat(F.col("recv").cast("string"), F.lit("L")).alias("recipientId"),
    )


def lisk_block_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.functions.clock import LISK_GENESIS

    return orders(spark, sf_dir).select((F.col("btime") - LISK_GENESIS).alias("timestamp")).distinct()


def nem_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.functions.clock import NEM_GENESIS

    o = orders(spark, sf_dir)
    multisig = F.col("prio") == "4-NOT SPECIFIED"
    recipient = F.concat(F.lit("N"), F.col("recv").cast("string"))
    tx = F.struct(
        ((F.col("k") % 50 + 1) * 100000).alias("fee"),
        F.when(multisig, F.when(F.col("k") % 13 == 0, F.lit(100).cast("long"))).otherwise(F.col("val")).alias("amount"),
        F.concat(F.lit("pk"), F.col("cust").cast("string")).alias("signer"),
        F.concat(F.lit("N"), (F.col("cust") % 700).cast("string")).alias("signerAddress"),
        F.when(~multisig, recipient).alias("recipient"),
        F.when(multisig, F.struct(F.col("val").alias("amount"), recipient.alias("recipient"))).alias("otherTrans"),
    )
    b = _blocks(o.select("num", "btime", tx.alias("tx")), ["num", "btime"])
    return b.select((F.col("btime") - NEM_GENESIS).alias("timeStamp"), "transactions")


RIPPLE_FIRST_INDEX = 32569


def ripple_ledgers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = orders(spark, sf_dir)
    k = F.col("k")
    account = F.concat(F.lit("r"), F.col("cust").cast("string"))
    tx = F.struct(
        (F.col("btime") + F.when(k % 5 == 0, 25200).otherwise(0)).alias("date"),
        F.when(F.col("prio") == "2-HIGH", "OfferCreate")
        .when((F.col("prio") == "3-MEDIUM") & (k % 3 == 0), F.lit(None).cast("string"))
        .otherwise("Payment")
        .alias("type"),
        F.when(F.col("status") == "P", "tecUNFUNDED").otherwise("tesSUCCESS").alias("result"),
        account.alias("account"),
        F.when(k % 11 == 0, account).otherwise(F.concat(F.lit("r"), F.col("recv").cast("string"))).alias("destination"),
        F.when(k % 7 == 0, "USD").alias("currency"),
        F.col("val").cast(D38).alias("amount"),
        ((k % 50 + 1) * 10).cast(D38).alias("fee"),
    )
    b = _blocks(o.select("num", "btime", tx.alias("tx")), ["num", "btime"])
    return b.select((F.col("num") + RIPPLE_FIRST_INDEX).alias("index"), F.col("btime").alias("closeTime"), "transactions")


def stellar_ledgers(spark: SparkSession, sf_dir: str) -> DataFrame:
    ptype = F.when(F.col("flag") == "N", 0).when(F.col("flag") == "A", 1).otherwise(2)
    code = F.when(F.col("part") % 3 == 1, "ETH").when(F.col("part") % 7 == 0, "USD").otherwise("BTC")
    op = F.struct(
        ptype.alias("type"),
        F.when(F.col("part") % 5 != 0, F.concat(F.lit("G"), F.col("cust").cast("string"))).alias("sourceAccount"),
        F.concat(F.lit("G"), F.when(F.col("part") % 13 == 0, F.col("cust")).otherwise(F.col("supp")).cast("string")).alias(
            "destination"
        ),
        F.when(ptype == 0, F.col("amt")).alias("amount"),
        F.when(ptype == 1, F.col("amt")).alias("startingBalance"),
        F.when(F.col("part") % 3 != 0, F.struct(code.alias("assetCode"))).alias("asset"),
    )
    o = _with_items(spark, sf_dir, op, "operations")
    tx = F.struct(
        F.concat(F.lit("G"), F.col("cust").cast("string")).alias("sourceAccount"),
        ((F.col("k") % 50 + 1) * 100).alias("fee"),
        "operations",
    )
    b = _blocks(o.select("num", "btime", tx.alias("tx")), ["num", "btime"])
    return b.select(F.col("num").alias("sequence"), F.col("btime").alias("closeTime"), "transactions")


def waves_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    transfer = F.struct(
        F.concat(F.lit("W"), F.col("supp").cast("string")).alias("recipient"), F.col("amt").alias("amount")
    )
    o = _with_items(spark, sf_dir, transfer, "transfers")
    ttype = F.when(F.col("prio") == "4-NOT SPECIFIED", 11).when(F.col("prio") == "5-LOW", 3).otherwise(4)
    tx = F.struct(
        (F.col("btime") * 1000 + F.col("k") % 1000).alias("timestamp"),
        ttype.alias("type"),
        F.when(F.col("k") % 6 == 0, "TKN").alias("assetId"),
        F.concat(F.lit("W"), F.col("cust").cast("string")).alias("sender"),
        F.when(ttype == 4, F.concat(F.lit("W"), F.col("recv").cast("string"))).alias("recipient"),
        F.when(ttype == 4, F.col("val")).alias("amount"),
        ((F.col("k") % 50 + 1) * 100000).alias("fee"),
        F.coalesce("transfers", F.array().cast("array<struct<recipient:string,amount:bigint>>")).alias("transfers"),
    )
    b = _blocks(o.select("num", "btime", tx.alias("tx")), ["num", "btime"])
    return b.select((F.col("btime") * 1000).alias("timestamp"), "transactions")
