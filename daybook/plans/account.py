"""Account-model chains: EOS (D02), Lisk (D15), NEM (D17), Waves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions import (
    LISK_GENESIS,
    NEM_GENESIS,
    byte_slice,
    day_of_millis,
    day_of_seconds,
    day_since,
    int64_le,
    padded_text,
    scale_units,
    units,
)
from daybook.functions.units import units_to_double
from daybook.operators import (
    address_counts,
    exact_median,
    exact_medians,
    stitch,
    total_if,
)
from daybook.operators.nesting import n_items
from daybook.operators.staging import stage


def _flow(df: DataFrame, scale: int, value: str = "units") -> DataFrame:
    """Count and exact sum per day, stitched with the address counts."""
    sums = df.groupBy("date").agg(F.count(F.lit(1)).alias("cnt"), scale_units(F.sum(value), scale).alias("value"))
    return sums.join(address_counts(df, ["date"], "from", "to"), "date", "left")


# ------------------------------------------------------------------- EOS
# EOS token precision (10^-4).
EOS_SCALE = 4


def eos_transfers(blocks: DataFrame) -> DataFrame:
    """Executed native EOS transfers decoded from action payloads."""
    b = blocks.select(day_of_seconds("timestamp").alias("date"), "transactions")
    tx = b.select("date", F.explode("transactions").alias("tx")).where(F.col("tx.status") == "executed")
    a = tx.select("date", F.explode("tx.actions").alias("a"))
    data = F.col("a.data")
    a = a.where(
        (F.col("a.name") == "transfer")
        & (F.col("a.account") == "eosio.token")
        & (padded_text(byte_slice(data, 26, 7)) == "EOS")
    )
    return a.select(
        "date",
        byte_slice(data, 1, 8).alias("from"),
        byte_slice(data, 9, 8).alias("to"),
        units(int64_le(byte_slice(data, 17, 8))).alias("units"),
    )


def eos_stats(blocks: DataFrame) -> DataFrame:
    b = blocks.select(day_of_seconds("timestamp").alias("date"), n_items("transactions").alias("n"))
    block_stats = b.groupBy("date").agg(F.count(F.lit(1)).alias("block_cnt"), F.sum("n").alias("tx_cnt"))
    tr = stage(eos_transfers(blocks))
    action_stats = _flow(tr, EOS_SCALE).withColumnRenamed("cnt", "action_cnt")
    med = exact_median(tr, ["date"], units_to_double("units", EOS_SCALE), "med_value", stage_input=False)
    out = stitch(block_stats, action_stats, med, on="date")
    return out.select(
        "date", "block_cnt", "tx_cnt", "action_cnt", "value", "med_value", "from_cnt", "to_cnt", "addr_cnt"
    )


# ------------------------------------------------------------------ Lisk
# Lisk beddows per LSK (10^-8).
LISK_SCALE = 8


def lisk_stats(trs: DataFrame) -> DataFrame:
    t = stage(trs.select(
        day_since("timestamp", LISK_GENESIS).alias("date"),
        units("amount").alias("units"),
        units("fee").alias("fee"),
        F.col("senderId").alias("from"),
        F.col("recipientId").alias("to"),
        "type",
    ))
    stats = t.groupBy("date").agg(
        F.count(F.lit(1)).alias("cnt"),
        scale_units(F.sum("units"), LISK_SCALE).alias("value"),
        scale_units(F.sum("fee"), LISK_SCALE).alias("fees"),
        total_if(F.col("type") == 0).alias("payment_cnt"),
    )
    meds = exact_medians(
        t, ["date"], {"med_value": units_to_double("units", LISK_SCALE), "med_fees": units_to_double("fee", LISK_SCALE)},
        stage_input=False,
    )
    addr = address_counts(t, ["date"], "from", "to")
    out = stitch(stats, meds, addr, on="date")
    return out.select(
        "date", "cnt", "value", "fees", "med_value", "med_fees", "from_cnt", "to_cnt", "payment_cnt", "addr_cnt"
    )


# ------------------------------------------------------------------- NEM
# NEM micro-XEM (10^-6).
NEM_SCALE = 6


def nem_transactions(blocks: DataFrame) -> DataFrame:
    """Transactions with the effective amount and recipient."""
    b = blocks.select(day_since("timeStamp", NEM_GENESIS).alias("date"), F.explode("transactions").alias("tx"))
    return b.select(
        "date",
        units("tx.fee").alias("fee"),
        units(F.coalesce(F.col("tx.amount"), F.lit(0)) + F.coalesce(F.col("tx.otherTrans.amount"), F.lit(0))).alias(
            "units"
        ),
        F.col("tx.signer").alias("signer"),
        F.col("tx.signerAddress").alias("signer_address"),
        F.coalesce(F.col("tx.recipient"), F.col("tx.otherTrans.recipient")).alias("to"),
    )


def nem_stats(blocks: DataFrame) -> DataFrame:
    t = stage(nem_transactions(blocks))
    stats = t.groupBy("date").agg(
        F.count(F.lit(1)).alias("cnt"),
        scale_units(F.sum("fee"), NEM_SCALE).alias("fees"),
        scale_units(F.sum("units"), NEM_SCALE).alias("value"),
    )
    meds = exact_medians(
        t, ["date"], {"med_fees": units_to_double("fee", NEM_SCALE), "med_value": units_to_double("units", NEM_SCALE)},
        stage_input=False,
    )
    # Signer keys, and addresses on either side, distinct in one pass; the two
    # name spaces are kept apart by a flag.
    names = F.array(
        F.struct(F.col("signer").alias("a"), F.lit(1).alias("key"), F.lit(0).alias("t")),
        F.struct(F.col("signer_address").alias("a"), F.lit(0).alias("key"), F.lit(0).alias("t")),
        F.struct(F.col("to").alias("a"), F.lit(0).alias("key"), F.lit(1).alias("t")),
    )
    per = t.select("date", F.explode(names).alias("s")).where(F.col("s.a").isNotNull())
    per = per.groupBy("date", F.col("s.key").alias("key"), F.col("s.a").alias("a")).agg(F.max("s.t").alias("t"))
    seen = per.groupBy("date").agg(F.sum("key").alias("from_cnt"), F.sum("t").cast("long").alias("to_cnt"), F.sum(1 - F.col("key")).alias("addr_cnt"))
    out = stitch(stats, meds, seen, on="date").fillna(0, ["from_cnt", "to_cnt", "addr_cnt"])
    return out.select("date", "cnt", "fees", "value", "med_fees", "med_value", "from_cnt", "to_cnt", "addr_cnt")


# ----------------------------------------------------------------- Waves
# Waves wavelets (10^-8).
WAVES_SCALE = 8


def waves_transactions(blocks: DataFrame) -> DataFrame:
    """Native single (type 4) and mass (type 11) transfer transactions: date,
    from, fee and the list of what they transfer (C19).

    A single transfer becomes a one-element list, so both kinds come out of
    one scan and one explode instead of a union of two scans.
    """
    tx = blocks.select(F.explode("transactions").alias("tx")).where(
        F.col("tx.type").isin(4, 11) & F.col("tx.assetId").isNull()
    )
    single = F.array(F.struct(F.col("tx.recipient").alias("recipient"), F.col("tx.amount").alias("amount")))
    parts = F.when(F.col("tx.type") == 4, single).otherwise(F.col("tx.transfers"))
    return tx.select(
        day_of_millis("tx.timestamp").alias("date"), F.col("tx.sender").alias("from"), units("tx.fee").alias("fee"), parts.alias("parts")
    )


def waves_stats(blocks: DataFrame) -> DataFrame:
    tx = stage(waves_transactions(blocks))
    tx_stats = tx.groupBy("date").agg(
        F.count(F.lit(1)).alias("cnt"), scale_units(F.sum("fee"), WAVES_SCALE).alias("fees")
    )
    med_f = exact_median(tx, ["date"], units_to_double("fee", WAVES_SCALE), "med_fees", stage_input=False)
    tr = tx.select("date", "from", F.explode("parts").alias("p")).select(
        "date", "from", F.col("p.recipient").alias("to"), units("p.amount").alias("units")
    )
    tr_stats = tr.groupBy("date").agg(scale_units(F.sum("units"), WAVES_SCALE).alias("value"))
    med_v = exact_median(tr, ["date"], units_to_double("units", WAVES_SCALE), "med_value", stage_input=False)
    addr = address_counts(tr, ["date"], "from", "to")
    out = stitch(tx_stats, med_f, tr_stats, med_v, addr, on="date")
    return out.select("date", "cnt", "value", "med_value", "fees", "med_fees", "from_cnt", "to_cnt", "addr_cnt")
