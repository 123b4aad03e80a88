"""IOTA daily statistics over complete bundles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions import day_of_seconds, seconds_or_millis, units
from daybook.operators import exact_median, stitch, total_if
from daybook.operators.staging import stage


def complete_bundles(txs: DataFrame):
    """(entries, bundles): reattachments collapsed per (bundle, index) with a
    per-column MAX (A17, §8 Q16), and bundles holding every index (A18)."""
    entries = stage(txs.groupBy("bundle", "currentIndex").agg(
        F.max(seconds_or_millis("timestamp")).alias("timestamp"),
        F.max("value").alias("value"),
        F.max("address").alias("address"),
        F.max("lastIndex").alias("lastIndex"),
    ))
    bundles = (
        entries.groupBy("bundle")
        .agg(
            F.max("timestamp").alias("timestamp"),
            F.sum(F.greatest(units("value"), F.lit(0))).alias("value"),
            (F.max("lastIndex") + 1 == F.count(F.lit(1))).alias("_complete"),
        )
        .where("_complete")
        .drop("_complete")
    )
    return entries, bundles


def iota_stats(txs: DataFrame) -> DataFrame:
    entries, bundles = complete_bundles(txs)
    b = stage(bundles.withColumn("date", day_of_seconds("timestamp")))
    bstats = b.groupBy("date").agg(F.count(F.lit(1)).alias("cnt"), F.sum("value").alias("value"))
    # A10: the median skips zero-value bundles.
    med = exact_median(
        b, ["date"], F.when(F.col("value") != 0, F.col("value")).cast("double"), "med_value", stage_input=False
    )
    # Entries of complete bundles, dated by their bundle.
    members = entries.join(b.select("bundle", "date"), "bundle")
    tstats = members.groupBy("date").agg(
        total_if(F.col("value") < 0).alias("from_cnt"),
        total_if(F.col("value") > 0).alias("to_cnt"),
        F.countDistinct("address").alias("addr_cnt"),
    )
    out = stitch(tstats, bstats, med, on="date")
    return out.select("date", "cnt", "value", "med_value", "from_cnt", "to_cnt", "addr_cnt")
