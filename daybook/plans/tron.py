"""Tron daily statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions import day_of_millis, scale_units, units
from daybook.functions.units import units_to_double
from daybook.operators import address_counts, exact_median, medians_of_counts, stitch, value_counts
from daybook.operators.distinct_sets import address_sets, merged_sets, numbered, set_counts, side_flags
from daybook.operators.nesting import n_items
from daybook.operators.staging import frozen, stage

# Tron sun per TRX (10^-6).
SCALE = 6


def tron_payments(blocks: DataFrame) -> DataFrame:
    """TransferContract payments of blocks after genesis: (date, from, to, units)."""
    b = blocks.where(F.col("number") > 0).select(day_of_millis("timestamp").alias("date"), "transactions")
    c = b.select("date", F.explode("transactions").alias("tx")).select("date", F.explode("tx.contracts").alias("c"))
    return c.where(F.col("c.type") == "TransferContract").select(
        "date",
        F.col("c.owner_address").alias("from"),
        F.col("c.to_address").alias("to"),
        units("c.amount").alias("units"),
    )


def tron_stats(blocks: DataFrame) -> DataFrame:
    """One row per day: blocks, transactions, payments, volume, median, addresses.

    The day comes from the blocks side (§8 Q11), so days without transactions
    still carry their date.
    """
    b = blocks.where(F.col("number") > 0).select(day_of_millis("timestamp").alias("date"), n_items("transactions").alias("n"))
    block_stats = b.groupBy("date").agg(F.count(F.lit(1)).alias("block_cnt"), F.sum("n").alias("tx_cnt"))
    pays = stage(tron_payments(blocks))
    pay_stats = pays.groupBy("date").agg(
        F.count(F.lit(1)).alias("payment_cnt"), scale_units(F.sum("units"), SCALE).alias("value")
    )
    med = exact_median(pays, ["date"], units_to_double("units", SCALE), "med_value", stage_input=False)
    addr = address_counts(pays, ["date"], "from", "to")
    out = stitch(block_stats, pay_stats, med, addr, on="date")
    return out.select(
        "date", "block_cnt", "tx_cnt", "payment_cnt", "value", "med_value", "from_cnt", "to_cnt", "addr_cnt"
    )


def tron_day_parts(blocks: DataFrame, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What the days leave to longer periods, stored: counts of paid values, address sets, numbers of the addresses."""
    pays = stage(tron_payments(blocks))
    values = frozen(value_counts(pays, ["date"], {"med_value": units_to_double("units", SCALE)}))
    flags = frozen(side_flags(pays, ["date"], "from", "to"))
    numbers = numbered(flags, known)
    return values, frozen(address_sets(flags, ["date"], numbers)), numbers


def tron_months(values: DataFrame, sets: DataFrame) -> DataFrame:
    """Payments, their exact median and distinct addresses of each month, out of stored days alone."""
    month = F.date_trunc("month", "date").cast("timestamp_ntz").alias("month")
    values, sets = (df.select(month, *[c for c in df.columns if c != "date"]) for df in (values, sets))
    paid = values.groupBy("month").agg(F.sum("_n").alias("payment_cnt"))
    counts = set_counts(merged_sets(sets, ["month"]), ["month"])
    return stitch(paid, medians_of_counts(values, ["month"], ["med_value"]), counts, on="month")
