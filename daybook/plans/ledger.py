"""Ledger-model chains: Ripple (D20, D21) and Stellar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions import day_of_seconds, day_text, scale_units, units
from daybook.functions.units import units_to_double
from daybook.operators import address_counts, exact_median, stitch, total_where
from daybook.operators.gaps import missing_by_day, missing_in_day
from daybook.operators.nesting import n_items
from daybook.operators.staging import stage

# Ripple drops per XRP (10^-6) and the first ledger index the
# gap search covers.
RIPPLE_SCALE = 6
RIPPLE_SERIES_START = 32570


def _ripple_tx(ledgers: DataFrame) -> DataFrame:
    return ledgers.select(
        day_of_seconds("closeTime").alias("ledger_date"), F.explode("transactions").alias("tx")
    )


def _is_xrp_payment() -> F.Column:
    tx = F.col("tx")
    return (
        (tx["result"] == "tesSUCCESS")
        & (tx["type"] == "Payment")
        & tx["currency"].isNull()
        & (tx["account"] != tx["destination"])
    )


def ripple_payment_stats(ledgers: DataFrame) -> DataFrame:
    """Full rebuild (D20): XRP payments by their own date, blocks by close day,
    gaps charged to the day before them across days (§8 Q17-Q19)."""
    return with_gaps(ripple_payment_days(ledgers), missing_by_day(ripple_indexes(ledgers), RIPPLE_SERIES_START))


def ripple_indexes(ledgers: DataFrame) -> DataFrame:
    return ledgers.select("index", day_of_seconds("closeTime").alias("date"))


def with_gaps(days: DataFrame, gaps: DataFrame) -> DataFrame:
    """The days of D20 with their gaps (date, missing_block_cnt)."""
    return stitch(days, gaps, on="date").select(
        "date", "cnt", "value", "fee", "from_cnt", "to_cnt", "addr_cnt", "block_cnt", "missing_block_cnt",
        "total_cnt", "missing_cnt",
    )


def ripple_payment_days(ledgers: DataFrame) -> DataFrame:
    """The columns of D20 that depend on a day's own ledgers and payments."""
    t = _ripple_tx(ledgers)
    pay = stage(t.where(_is_xrp_payment()).select(
        day_of_seconds("tx.date").alias("date"),
        units("tx.amount").alias("amount"),
        units("tx.fee").alias("fee"),
        F.col("tx.account").alias("from"),
        F.col("tx.destination").alias("to"),
    ))
    txs = pay.groupBy("date").agg(
        F.count(F.lit(1)).alias("cnt"),
        scale_units(F.sum("amount"), RIPPLE_SCALE).alias("value"),
        scale_units(F.sum("fee"), RIPPLE_SCALE).alias("fee"),
    )
    addr = address_counts(pay, ["date"], "from", "to")
    led = ledgers.select(day_of_seconds("closeTime").alias("date"), "transactions")
    blocks = led.groupBy("date").agg(
        F.count(F.lit(1)).alias("block_cnt"), F.sum(n_items("transactions")).alias("total_cnt")
    )
    missing_tx = (
        t.where(F.col("tx.type").isNull())
        .groupBy(F.col("ledger_date").alias("date"))
        .agg(F.count(F.lit(1)).alias("missing_cnt"))
    )
    return stitch(txs, addr, blocks, missing_tx, on="date")


def ripple_daily(ledgers: DataFrame) -> DataFrame:
    """Per-day statistics of the incremental dataset (D21): all successful
    transactions for fees and addresses, XRP payments for volume, gaps inside
    each day only.  ``refresh_days`` applies it to open days."""
    t = _ripple_tx(ledgers).withColumnRenamed("ledger_date", "date")
    tx = stage(t.select(
        "date",
        (F.col("tx.result") == "tesSUCCESS").alias("ok"),
        F.col("tx.type").isNull().alias("missing"),
        _is_xrp_payment().alias("pays"),
        units("tx.fee").alias("fee"),
        units("tx.amount").alias("amount"),
        F.col("tx.account").alias("from"),
        F.col("tx.destination").alias("to"),
    ))
    ok, pay = tx.where("ok"), tx.where("pays")
    tx_stats = ok.groupBy("date").agg(
        F.count(F.lit(1)).alias("cnt"), scale_units(F.sum("fee"), RIPPLE_SCALE).alias("fee")
    )
    med_fee = exact_median(ok, ["date"], units_to_double("fee", RIPPLE_SCALE), "med_fee", stage_input=False)
    pay_stats = pay.groupBy("date").agg(
        F.count(F.lit(1)).alias("payment_cnt"), scale_units(F.sum("amount"), RIPPLE_SCALE).alias("payment_value")
    )
    med_pay = exact_median(pay, ["date"], units_to_double("amount", RIPPLE_SCALE), "med_payment_value", stage_input=False)
    addr = address_counts(ok, ["date"], "from", "to")
    blocks = missing_in_day(ledgers.select("index", day_of_seconds("closeTime").alias("date")))
    missing_tx = tx.where("missing").groupBy("date").agg(F.count(F.lit(1)).alias("missing_cnt"))
    out = stitch(tx_stats, med_fee, addr, pay_stats, med_pay, blocks, missing_tx, on="date")
    return out.select(
        "date", "cnt", "fee", "med_fee", "from_cnt", "to_cnt", "addr_cnt", "payment_cnt", "payment_value",
        "med_payment_value", "block_cnt", "missing_block_cnt", "missing_cnt",
    )


# Stellar stroops per lumen (10^-7).
STELLAR_SCALE = 7


def stellar_payments(ledgers: DataFrame) -> DataFrame:
    """Payments (type 0) and account creations (type 1) between two accounts.

    The reference's test ``(op.source NOT NULL OR tx.source <> dest) AND
    op.source <> dest`` reduces to ``op.source <> dest`` (§8 Q12).
    """
    tx = ledgers.select(
        day_of_seconds("closeTime").alias("date"), "sequence", F.posexplode("transactions").alias("txpos", "tx")
    )
    op = tx.select("date", "sequence", "txpos", F.explode("tx.operations").alias("op"))
    op = op.where(F.col("op.type").isin(0, 1) & (F.col("op.sourceAccount") != F.col("op.destination")))
    amount = F.coalesce(F.col("op.amount"), F.lit(0)) + F.coalesce(F.col("op.startingBalance"), F.lit(0))
    return op.select(
        "date",
        "sequence",
        "txpos",
        F.coalesce(F.col("op.asset.assetCode"), F.lit("")).alias("asset"),
        units(amount).alias("units"),
        F.col("op.sourceAccount").alias("from"),
        F.col("op.destination").alias("to"),
    )


def _stellar_tx_stats(ledgers: DataFrame) -> DataFrame:
    tx = ledgers.select(day_of_seconds("closeTime").alias("date"), F.explode("transactions").alias("tx"))
    return tx.groupBy("date").agg(
        F.count(F.lit(1)).alias("tx_cnt"), scale_units(F.sum(units("tx.fee")), STELLAR_SCALE).alias("fees")
    )


def stellar_payment_stats(ledgers: DataFrame) -> DataFrame:
    """Per day and asset (D22); ``fees`` is the whole day's fees (§8 Q14)."""
    p = stage(stellar_payments(ledgers))
    keys = ["date", "asset"]
    ops = p.groupBy(*keys).agg(
        F.countDistinct(F.struct("sequence", "txpos")).alias("cnt"),
        scale_units(F.sum("units"), STELLAR_SCALE).alias("value"),
    )
    addr = address_counts(p, keys, "from", "to")
    fees = _stellar_tx_stats(ledgers).select("date", "fees")
    out = stitch(ops, fees, on="date")
    out = stitch(out, addr, on=keys)
    return out.select("date", "asset", "cnt", "value", "fees", "from_cnt", "to_cnt", "addr_cnt")


# Assets pivoted into columns, and their column labels
# (the native asset is labelled XRP, §8 Q15).
STELLAR_PIVOT = [("", "XRP"), ("ETH", "ETH"), ("BTC", "BTC")]


def stellar_stats(ledgers: DataFrame, payment_stats: DataFrame | None = None) -> DataFrame:
    """Daily totals with three assets pivoted into columns."""
    ps = stellar_payment_stats(ledgers) if payment_stats is None else payment_stats
    aggs = []
    for asset, label in STELLAR_PIVOT:
        hit = F.col("asset") == asset
        aggs += [
            total_where("cnt", hit).alias(f"paymentTxCount({label})"),
            total_where("value", hit).alias(f"paymentTxVolume({label})"),
            total_where("fees", hit).alias(f"paymentFees({label})"),
        ]
    pivot = ps.groupBy("date").agg(*aggs)
    tx = _stellar_tx_stats(ledgers)
    out = stitch(tx, pivot, on="date")
    return out.select(
        day_text("date").alias("date"),
        F.col("tx_cnt").alias("txCount"),
        "fees",
        *[c for c in pivot.columns if c != "date"],
    )
