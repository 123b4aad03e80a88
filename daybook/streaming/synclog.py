"""Sync log: the latest block time behind each refresh.

Each chain has its own clock; ``SYNC_CLOCKS`` turns a chain's raw table into
its latest block time.  The time is fixed before the job, on the job's own
input; the data is published next and the log row appended last, so the log
never runs ahead of the data (§8 Q33).
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import LISK_GENESIS, NEM_GENESIS, seconds_or_millis, time_of_seconds

def _secs(col: str) -> Column:
    return time_of_seconds(F.max(col))


def _millis(col: str) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MILLISECOND", F.max(col), epoch)


# Which field is each chain's clock, and its unit.
SYNC_CLOCKS = {
    "cardano": lambda df: df.agg(_secs("timeIssued")),
    "ripple_payment_xrp": lambda df: df.agg(_secs("closeTime")),
    "stellar": lambda df: df.agg(_secs("closeTime")),
    "iota": lambda df: df.agg(time_of_seconds(F.max(seconds_or_millis("timestamp")))),
    "monero": lambda df: df.agg(_secs("timestamp")),
    "nem": lambda df: df.agg(time_of_seconds(F.max("timeStamp") + F.lit(NEM_GENESIS))),
    "neo": lambda df: df.agg(_secs("time")),
    "lisk": lambda df: df.agg(time_of_seconds(F.max("timestamp") + F.lit(LISK_GENESIS))),
    "eos": lambda df: df.agg(_secs("timestamp")),
    "waves": lambda df: df.agg(_millis("timestamp")),
}


def sync_watermark(view: str, source: DataFrame) -> DataFrame:
    """One row (view, sync_time) for a chain's raw table."""
    t = SYNC_CLOCKS[view](source)
    return t.select(F.lit(view).alias("view"), F.col(t.columns[0]).alias("sync_time"))


def sync_watermarks(sources: dict[str, DataFrame]) -> DataFrame:
    """Watermarks of several chains as one DataFrame."""
    out = None
    for view, df in sources.items():
        row = sync_watermark(view, df)
        out = row if out is None else out.unionByName(row)
    return out


def watermark(view: str, source: DataFrame):
    """The latest block time of ``source``, taken before its job runs.

    Taken from the same DataFrame (and so the same file listing) as the job,
    it never names a block the published data does not hold.
    """
    return sync_watermark(view, source).first()["sync_time"]


def append_sync(spark: SparkSession, log_path: str, view: str, sync_time) -> DataFrame:
    """Append (time, view, sync_time) to the sync log and return the row."""
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    row = spark.createDataFrame([(now, view, sync_time)], "time timestamp_ntz, view string, sync_time timestamp_ntz")
    row.coalesce(1).write.mode("append").parquet(log_path)
    return row
