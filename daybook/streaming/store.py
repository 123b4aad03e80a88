"""Published per-day tables: Parquet partitioned by month, written by Spark's dynamic overwrite.

A publication from a day on replaces the months from that day's on: the rows
of the first month's earlier days come along, months without rows any more are
removed, and files of closed months are never touched (§8 Q4).  Without a first
day it replaces the table.  A month rather than a day, as a day of most tables
is one row, and a folder a day would be listed at each read.

Rows are staged before the write, so a job may read the table that it is about
to change.  Spark moves finished partitions into place when the whole write has
succeeded; a write that died leaves a hidden folder that no reader sees.  A table
without days (a registry) is replaced whole.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.staging import frozen
from daybook.sources.storage import delete, read_if_there

MONTH = "month"
#: Partition that keeps the schema of a table without rows.
NO_MONTH = 101


def _month(day: dt.datetime) -> int:
    return day.year * 100 + day.month


def _months(stored: DataFrame | None) -> list[int]:
    """Months of a stored table, from the partition names alone."""
    return [] if stored is None else [r[MONTH] for r in stored.select(MONTH).distinct().collect() if r[MONTH] is not None]


def read_published(spark: SparkSession, path: str, since: dt.datetime | None = None) -> DataFrame:
    """A published table, or its rows from day ``since`` on, of which only the months are read."""
    stored = read_if_there(spark, path)
    if stored is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    if since is not None:
        stored = stored.where((F.col(MONTH) >= _month(since)) & (F.col("date") >= F.lit(since)))
    return stored.drop(MONTH)


def last_published_day(spark: SparkSession, path: str) -> dt.datetime | None:
    """Latest day of the target, or None when nothing is published."""
    stored = read_if_there(spark, path)
    months = _months(stored)
    return stored.where(F.col(MONTH) == max(months)).agg(F.max("date")).first()[0] if months else None


def publish(df: DataFrame, path: str, *, begin: dt.datetime | None = None) -> None:
    """Publish ``df`` as all rows from day ``begin`` on (None: as the whole table, S5, S12)."""
    spark = df.sparkSession
    if "date" not in df.columns:  # a registry
        frozen(df).write.mode("overwrite").parquet(path)
        return
    stored = None if begin is None else read_if_there(spark, path)
    if stored is not None:
        kept = stored.where((F.col(MONTH) == _month(begin)) & (F.col("date") < F.lit(begin))).drop(MONTH)
        df = kept.unionByName(df)
    rows = frozen(df.withColumn(MONTH, (F.year("date") * 100 + F.month("date")).cast("int")))
    months, before = set(_months(rows)), set(_months(stored))
    gone = {m for m in before if m >= _month(begin)} - months if begin is not None else set()
    # one file a month, more where a month is large
    writer = rows.hint("rebalance", MONTH).write.mode("overwrite").partitionBy(MONTH)
    writer.option("partitionOverwriteMode", "static" if begin is None else "dynamic").parquet(path)
    if not months and not before - gone:
        rows.drop(MONTH).limit(0).write.mode("overwrite").parquet(f"{path}/{MONTH}={NO_MONTH}")
    for month in gone - {NO_MONTH}:
        delete(spark, f"{path}/{MONTH}={month}")
    if months and NO_MONTH in before:
        delete(spark, f"{path}/{MONTH}={NO_MONTH}")
