"""Missing-block detection in a ledger index sequence.

The reference enumerates every index from a fixed start and searches, for
each gap start, the nearest gap end with a correlated subquery — quadratic
in the number of gaps.  Here each present index finds its successor: inside
a bucket of ``bucket_width`` consecutive index values with a window (at most
``bucket_width`` rows per window partition, whatever the skew), and across
buckets through a small per-bucket table (one row per non-empty bucket).
A gap is any successor more than one index away; its size is charged to the
day of the ledger just before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_WIDTH = 1 << 20


def successors(index_days: DataFrame, start: int, bucket_width: int | None = None) -> DataFrame:
    """(index, date, next_index) for each present index >= start - 1."""
    bucket_width = bucket_width or DEFAULT_BUCKET_WIDTH
    p = (
        index_days.where(F.col("index") >= F.lit(start - 1))
        .groupBy("index")
        .agg(F.min("date").alias("date"))
        .withColumn("_b", F.floor(F.col("index") / F.lit(bucket_width)).cast("long"))
    )
    inside = Window.partitionBy("_b").orderBy("index")
    p = p.withColumn("_next_in", F.lead("index").over(inside))
    buckets = p.groupBy("_b").agg(F.min("index").alias("_bmin"), F.max("index").alias("_bmax"))
    # One row per non-empty bucket: a single ordered window over this table is small.
    buckets = buckets.withColumn("_next_b", F.lead("_bmin").over(Window.orderBy("_b")))
    p = p.join(buckets.select("_b", "_bmax", "_next_b"), "_b")
    nxt = F.coalesce(F.col("_next_in"), F.when(F.col("index") == F.col("_bmax"), F.col("_next_b")))
    return p.select("index", "date", nxt.alias("next_index"))


def missing_ranges(index_days: DataFrame, start: int, bucket_width: int | None = None) -> DataFrame:
    """Gaps after ``start - 1``: (begin, end, begin_date, cnt) (C11).

    ``index_days`` has columns (index, date).  A gap that starts right at
    ``start`` counts only if ``start - 1`` itself is present, as in the
    reference's series walk.
    """
    s = successors(index_days, start, bucket_width)
    g = s.where(F.col("next_index") - F.col("index") > 1)
    return g.select(
        (F.col("index") + 1).alias("begin"),
        (F.col("next_index") - 1).alias("end"),
        F.col("date").alias("begin_date"),
        (F.col("next_index") - F.col("index") - 1).alias("cnt"),
    )


def missing_by_day(index_days: DataFrame, start: int, name: str = "missing_block_cnt", **kw) -> DataFrame:
    """Total gap size per day of the ledger before each gap (C11 roll-up)."""
    r = missing_ranges(index_days, start, **kw)
    return r.groupBy(F.col("begin_date").alias("date")).agg(F.sum("cnt").alias(name))


def missing_in_day(index_days: DataFrame, name: str = "missing_block_cnt") -> DataFrame:
    """Per-day MAX(index) - MIN(index) + 1 - COUNT(*): gaps inside one day only."""
    return index_days.groupBy("date").agg(
        F.count(F.lit(1)).alias("block_cnt"),
        (F.max("index") - F.min("index") + 1 - F.count(F.lit(1))).alias(name),
    )


def runs(index_days: DataFrame, start: int, bucket_width: int | None = None) -> DataFrame:
    """(bucket, begin, end, end_date): the present indexes from ``start - 1`` on as runs without a gap.

    Runs end at the borders of buckets, so that each bucket can be merged by
    itself; ``end_date`` is the day of the run's last ledger, its least one
    where that ledger comes more than once.
    """
    width = F.lit(bucket_width or DEFAULT_BUCKET_WIDTH)
    one = index_days.where(F.col("index") >= F.lit(start - 1)).groupBy("index").agg(F.min("date").alias("end_date"))
    one = one.withColumn("bucket", F.floor(F.col("index") / width).cast("long"))
    row = F.row_number().over(Window.partitionBy("bucket").orderBy("index"))
    return one.withColumn("_run", F.col("index") - row).groupBy("bucket", "_run").agg(
        F.min("index").alias("begin"), F.max("index").alias("end"), F.max_by("end_date", "index").alias("end_date")
    ).drop("_run")


def merged_runs(some: DataFrame) -> DataFrame:
    """The same present indexes as the fewest runs.

    Runs that overlap, touch or repeat become one, so runs found again, or
    found in ledgers that came late, may simply be added to stored ones.
    """
    before = Window.partitionBy("bucket").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max("end").over(before)
    opens = F.when(reach.isNull() | (F.col("begin") > reach + 1), 1).otherwise(0)
    upto = Window.partitionBy("bucket").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, 0)
    parts = some.withColumn("_opens", opens).withColumn("_run", F.sum("_opens").over(upto))
    last = F.struct("end", -F.unix_date(F.col("end_date").cast("date")))  # of the same last ledger, the earlier day
    return parts.groupBy("bucket", "_run").agg(
        F.min("begin").alias("begin"), F.max("end").alias("end"), F.max_by("end_date", last).alias("end_date")
    ).drop("_run")


def missing_of_runs(some: DataFrame, name: str = "missing_block_cnt") -> DataFrame:
    """``missing_by_day`` of the ledgers in ``merged_runs``: (date, name)."""
    following = F.lead("begin").over(Window.partitionBy("bucket").orderBy("begin"))
    inside = some.withColumn("_next", following)
    # one row a bucket, as in ``successors``
    buckets = some.groupBy("bucket").agg(F.min("begin").alias("_first")).withColumn("_after", F.lead("_first").over(Window.orderBy("bucket")))
    gap = F.coalesce("_next", "_after") - F.col("end") - 1
    found = inside.join(buckets.select("bucket", "_after"), "bucket").select(F.col("end_date").alias("date"), gap.alias("_gap"))
    return found.where(F.col("_gap") > 0).groupBy("date").agg(F.sum("_gap").alias(name))
