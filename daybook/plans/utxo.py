"""UTXO chains: Cardano (D01), Monero (D16), NEO."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions import day_of_seconds, epoch_seconds, scale_units, units
from daybook.functions.units import units_to_double
from daybook.operators import exact_avg, exact_median, exact_medians, stitch
from daybook.operators.staging import stage
from daybook.operators.flows import (
    net_by_tx_address,
    outpoint_spends,
    payment_count,
    short_lived_addresses,
    signed_rows,
)

# Cardano lovelace scale and the short-lived span (seconds).
CARDANO_SCALE = 6
CARDANO_SHORT_SPAN = 2400


def cardano_stats(blocks: DataFrame) -> DataFrame:
    tx = blocks.select(F.explode("transactions").alias("tx")).select(
        F.col("tx.id").alias("txid"),
        F.col("tx.timeIssued").alias("time"),
        day_of_seconds("tx.timeIssued").alias("date"),
        F.col("tx.inputs").alias("inputs"),
        F.col("tx.outputs").alias("outputs"),
    )
    tp = signed_rows(tx, "inputs", "outputs", ["txid", "time", "date"])  # unnested at each reading, as the blocks are stored
    short = short_lived_addresses(tp, CARDANO_SHORT_SPAN).select("address")
    txio = stage(net_by_tx_address(tp, ["txid", "address"]))
    positive = F.greatest(F.col("value"), F.lit(0))
    txq = txio.groupBy("txid").agg(
        (-F.sum("value")).alias("fees"),
        F.sum(positive).alias("volume"),
        payment_count(F.sum("output_cnt")).alias("payment_cnt"),
    )
    # Short-lived addresses are few; only their rows are looked up, and
    # what they add up to is attached by transaction.
    short_tx = txio.join(short, "address").groupBy("txid").agg(F.sum(positive).alias("short_volume"))
    # Each transaction to its own aggregate (txids are unique).
    per_tx = stage(tx.select("txid", "date").join(txq, "txid").join(short_tx, "txid", "left"))
    txs = per_tx.groupBy("date").agg(
        F.count(F.lit(1)).alias("cnt"),
        scale_units(F.sum("fees"), CARDANO_SCALE).alias("fees"),
        scale_units(F.sum("volume"), CARDANO_SCALE).alias("volume"),
        F.sum("payment_cnt").alias("payment_cnt"),
        scale_units(F.sum("short_volume"), CARDANO_SCALE).alias("short_volume"),
    )
    meds = exact_medians(
        per_tx,
        ["date"],
        {"med_volume": units_to_double("volume", CARDANO_SCALE), "med_fees": units_to_double("fees", CARDANO_SCALE)},
        stage_input=False,
    )
    # Input, output and either-side addresses in one (day, address) pass.
    per_addr = tp.groupBy("date", "address").agg(
        F.max(1 - F.col("is_output")).alias("f"), F.max("is_output").alias("t")
    )
    known = F.col("address").isNotNull()
    sides = per_addr.groupBy("date").agg(
        F.sum(F.when(known, F.col("f")).otherwise(0)).cast("long").alias("from_cnt"),
        F.sum(F.when(known, F.col("t")).otherwise(0)).cast("long").alias("to_cnt"),
        F.count("address").alias("addr_cnt"),
    )
    out = stitch(txs, meds, sides, on="date")
    return out.select(
        "date", "cnt", "volume", "fees", "med_volume", "med_fees", "payment_cnt", "short_volume", "from_cnt",
        "to_cnt", "addr_cnt",
    )


# Monero piconero scale; from this height on, transactions
# carry their fee.
MONERO_SCALE = 12
MONERO_FEE_FIELD_HEIGHT = 1220516


def _array_total(arr: str) -> F.Column:
    """Sum of an array's amounts; NULL for an empty array, as an inner join would give."""
    total = F.aggregate(F.col(arr), F.lit(0).cast("decimal(38,0)"), lambda acc, x: acc + x["amount"])
    return F.when(F.size(arr) > 0, total)


def monero_stats(blocks: DataFrame) -> DataFrame:
    """Daily blocks and transactions.

    Input and output sums per transaction are array aggregates over the
    transaction's own row: no shuffle, and the same as the reference's join
    on the transaction hash when hashes are unique (§8 Q20).
    """
    b = blocks.select(
        day_of_seconds("timestamp").alias("date"), "height", "size", "reward", "difficulty", "transactions"
    )
    bs = b.groupBy("date").agg(
        F.count(F.lit(1)).alias("block_cnt"),
        F.sum("size").alias("block_size"),
        scale_units(F.sum("reward"), MONERO_SCALE).alias("reward"),
        exact_avg("difficulty").alias("avg_difficulty"),
    )
    tx = b.select("date", "height", F.explode("transactions").alias("tx")).select(
        "date",
        "height",
        units("tx.fee").alias("fee"),
        _array_total("tx.vin").alias("in_amount"),
        F.when(F.size("tx.vin") > 0, F.size("tx.vin")).alias("in_cnt"),
        _array_total("tx.vout").alias("out_amount"),
        F.when(F.size("tx.vout") > 0, F.size("tx.vout")).alias("out_cnt"),
    )
    tx = stage(tx.withColumn(
        "fee_units",
        F.when(F.col("height") < MONERO_FEE_FIELD_HEIGHT, F.col("in_amount") - F.col("out_amount")).otherwise(
            F.col("fee")
        ),
    ))
    txs = tx.groupBy("date").agg(
        F.count(F.lit(1)).alias("cnt"),
        scale_units(F.sum("fee_units"), MONERO_SCALE).alias("fees"),
        F.sum(F.coalesce("in_cnt", F.lit(0)) + F.coalesce("out_cnt", F.lit(0))).alias("io_cnt"),
        F.sum(payment_count(F.col("out_cnt"))).alias("payment_cnt"),
    )
    med = exact_median(tx, ["date"], units_to_double("fee_units", MONERO_SCALE), "med_fees", stage_input=False)
    out = stitch(bs, txs, med, on="date")
    return out.select(
        "date", "block_cnt", "block_size", "reward", "avg_difficulty", "cnt", "fees", "med_fees", "io_cnt",
        "payment_cnt",
    )


def neo_outputs(blocks: DataFrame) -> DataFrame:
    """Numbered outputs (P3): date, blk, txid, voutnum, asset, value, address, fee."""
    tx = blocks.select(day_of_seconds("time").alias("date"), F.col("index").alias("blk"), F.explode("tx").alias("tx"))
    o = tx.select(
        "date", "blk", F.col("tx.txid").alias("txid"), (F.col("tx.sys_fee") + F.col("tx.net_fee")).alias("fee"),
        F.posexplode("tx.vout").alias("voutnum", "o"),
    )
    return o.select("date", "blk", "txid", "voutnum", "o.asset", "o.value", "o.address", "fee")


def neo_spends(blocks: DataFrame) -> DataFrame:
    """Inputs with the outpoints they spend: date, blk, txid, fee, vout_txid, vout_num."""
    tx = blocks.select(day_of_seconds("time").alias("date"), F.col("index").alias("blk"), F.explode("tx").alias("tx"))
    v = tx.select(
        "date", "blk", F.col("tx.txid").alias("txid"), (F.col("tx.sys_fee") + F.col("tx.net_fee")).alias("fee"),
        F.explode("tx.vin").alias("vin"),
    )
    # typed as output numbers are: a cast on their side would undo its buckets
    return v.select("date", "blk", "txid", "fee", F.col("vin.txid").alias("vout_txid"), F.col("vin.vout").cast("int").alias("vout_num"))


def neo_inputs(blocks: DataFrame, *outputs: DataFrame) -> DataFrame:
    """Inputs valued through the outputs they spend, negated.

    Several tables of outputs, none in two of them, are met one by one, so
    that each keeps its own partitioning.
    """
    v = neo_spends(blocks) if len(outputs) == 1 else stage(neo_spends(blocks))
    met = [outpoint_spends(v, o.select("txid", "voutnum", "asset", "value", "address")) for o in outputs]
    spent = reduce(DataFrame.unionByName, met)
    return spent.select("date", "blk", "txid", "fee", "asset", (-F.col("value")).alias("value"), "address")


#: An outpoint: what a spend names, and the key of the unspent outputs.
OUTPOINT = ("txid", "voutnum")


def neo_unspent(blocks: DataFrame) -> DataFrame:
    """Outputs that no input of ``blocks`` spends: date, txid, voutnum, asset, value, address."""
    o = neo_outputs(blocks).select("date", *OUTPOINT, "asset", "value", "address")
    return o.join(_spent_outpoints(blocks), list(OUTPOINT), "left_anti")


def neo_unspent_later(unspent: DataFrame, blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the outputs ``unspent`` before ``blocks`` those that they leave, unshuffled, and their own."""
    # merged by hint: sorted buckets stay where they are, whatever the other side's size
    return unspent.join(_spent_outpoints(blocks).hint("merge"), list(OUTPOINT), "left_anti"), neo_unspent(blocks)


def _spent_outpoints(blocks: DataFrame) -> DataFrame:
    return neo_spends(blocks).select(F.col("vout_txid").alias("txid"), F.col("vout_num").alias("voutnum"))


def neo_stats(blocks: DataFrame, since=None, outputs: DataFrame | None = None) -> DataFrame:
    """Per day and asset (D18, D19).  ``cnt`` counts (tx, address) rows and
    fees repeat per row (§8 Q9); a (day, asset) without inputs is dropped by
    the inner joins (§8 Q10).

    With ``since`` only days from ``since`` on are computed; ``outputs`` (those
    of earlier days that are unspent, or all of them) then values their inputs
    too, so that ``blocks`` need only hold the open days.
    """
    if since is not None:
        blocks = blocks.where(F.col("time") >= F.lit(epoch_seconds(since)))
    # Blocks are stored: unnesting them at each reading costs less than a copy of their outputs.
    txo = neo_outputs(blocks) if since is not None or outputs is None else outputs
    earlier = [] if since is None or outputs is None else [outputs.where(F.col("date") < F.lit(since))]
    txi = neo_inputs(blocks, txo, *earlier)
    cols = ["date", "blk", "txid", "fee", "asset", "value", "address"]
    both = txi.select(*cols, F.lit(1).alias("is_in")).unionByName(txo.select(*cols, F.lit(0).alias("is_in")))
    keys = ["date", "asset"]
    # One shuffle, by (day, asset, address), serves the sums per transaction and the
    # addresses of each day: an address is counted on one of its rows there.
    txio = both.repartition(*keys, "address").groupBy(*cols[:5], "address").agg(
        F.greatest(F.sum("value"), F.lit(0)).alias("value"),
        F.max("is_in").alias("f"),
        F.max(1 - F.col("is_in")).alias("t"),
    )
    own = Window.partitionBy(*keys, "address")
    first = F.row_number().over(own.orderBy("blk", "txid", "fee")) == 1
    known = first & F.col("address").isNotNull()
    txio = txio.select(
        *keys, "fee", "value", "f", "t", known.alias("_known"),
        F.max("f").over(own).alias("_from"), F.max("t").over(own).alias("_to"),
    )
    txio = stage(txio)
    stats = txio.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("cnt"),
        F.sum("fee").alias("fees"),
        F.sum("value").alias("value"),
        F.sum(F.when(F.col("_known"), F.col("_from")).otherwise(0)).cast("long").alias("from_cnt"),
        F.sum(F.when(F.col("_known"), F.col("_to")).otherwise(0)).cast("long").alias("to_cnt"),
        F.count(F.when(F.col("_known"), 1)).alias("addr_cnt"),
        F.max("f").alias("_f"),
        F.max("t").alias("_t"),
    )
    meds = exact_medians(txio, keys, {"med_fees": F.col("fee"), "med_value": F.col("value")}, stage_input=False)
    # As in a join on both keys, a day or asset that is NULL drops out.
    stats = stats.where("_f = 1 AND _t = 1 AND date IS NOT NULL AND asset IS NOT NULL")
    out = stitch(stats, meds, on=keys)
    return out.select("date", "asset", "cnt", "fees", "med_fees", "value", "med_value", "from_cnt", "to_cnt", "addr_cnt")
