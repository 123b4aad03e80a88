"""Value flows in UTXO ledgers.

Inputs and outputs of a transaction become signed rows in one scan (inputs
negated), then ordinary aggregations give per-(tx, address) nets, fees and
volumes.  Every step is a map-side-combined ``groupBy`` or an equi-join on
a unique key (outpoint or txid), so no group is gathered into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def signed_rows(tx: DataFrame, inputs: str, outputs: str, keep: Sequence[str], value: str = "value") -> DataFrame:
    """Inputs (negated, is_output 0) and outputs (is_output 1) of each tx.

    ``tx`` has one row per transaction with ``inputs``/``outputs`` arrays of
    structs holding ``address`` and ``value``; one explode of the
    concatenated arrays replaces a union of two scans.
    """
    ins = F.transform(
        F.col(inputs),
        lambda x: F.struct(x["address"].alias("address"), (-x[value]).alias("value"), F.lit(0).alias("is_output")),
    )
    outs = F.transform(
        F.col(outputs),
        lambda x: F.struct(x["address"].alias("address"), x[value].alias("value"), F.lit(1).alias("is_output")),
    )
    r = tx.select(*keep, F.explode(F.concat(ins, outs)).alias("_r"))
    return r.select(*keep, "_r.address", "_r.value", "_r.is_output")


def short_lived_addresses(rows: DataFrame, max_span: int, address: str = "address", time: str = "time",
                          value: str = "value") -> DataFrame:
    """Addresses whose whole history nets to exactly zero within ``max_span``
    seconds (C6).  Returns address, cnt, positive_value, min_time."""
    g = rows.groupBy(address).agg(
        F.count(F.lit(1)).alias("cnt"),
        F.sum(F.greatest(F.col(value), F.lit(0))).alias("positive_value"),
        F.min(time).alias("min_time"),
        F.max(time).alias("_max_time"),
        F.sum(value).alias("_net"),
    )
    g = g.where((F.col("_net") == 0) & (F.col("_max_time") - F.col("min_time") <= F.lit(max_span)))
    return g.select(F.col(address).alias("address"), "cnt", "positive_value", "min_time")


def net_by_tx_address(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Signed sum and output count per (tx, address[, asset])."""
    return rows.groupBy(*keys).agg(F.sum("value").alias("value"), F.sum("is_output").alias("output_cnt"))


def payment_count(outputs: Column) -> Column:
    """Outputs minus one (change), not below zero."""
    return F.greatest(outputs - F.lit(1), F.lit(0))


def outpoint_spends(vins: DataFrame, txos: DataFrame) -> DataFrame:
    """Each input joined to the output it spends on (txid, output number).

    ``vins``: vout_txid, vout_num plus carried columns; ``txos``: txid,
    voutnum, asset, value, address.  An outpoint is spent once, so the
    shuffled equi-join has no hot key.
    """
    o = txos.select(
        F.col("txid").alias("_otxid"), F.col("voutnum").alias("_onum"), F.col("asset"), F.col("value"),
        F.col("address"),
    )
    j = vins.join(o, (vins["vout_txid"] == o["_otxid"]) & (vins["vout_num"] == o["_onum"]))
    return j.drop("_otxid", "_onum", "vout_txid", "vout_num")
