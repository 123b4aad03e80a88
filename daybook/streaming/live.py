"""Live refresh: a Structured Streaming file source drives the day refresh.

Files that land in a raw folder are noticed by Spark's file source, whose
checkpoint remembers which ones were seen.  Each micro-batch says which day its
earliest row belongs to; the days from there on are recomputed out of the raw
folder and replace the published ones.  A late block thus reopens its day and
the ones after it, and what is published equals a batch run over all files.

Only the clock column of new files is read by the stream itself.  A batch that
ran but was not recorded runs again after a restart: publishing days is
repeatable, and so must ``note`` be.  ``availableNow`` works off what is there
and stops; with ``every`` (such as "10 minutes") the stream goes on.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from daybook.operators.staging import scope
from daybook.sources.storage import read_if_there
from daybook.streaming.clocks import Clock
from daybook.streaming.refresh import open_days
from daybook.streaming.store import last_published_day, publish


def first_day(rows: DataFrame, clock: Clock) -> dt.datetime | None:
    """The day of the earliest row."""
    first = rows.agg(F.min(clock.column)).first()[0]
    if first is None:
        return None
    at = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=int(first) // clock.per_second)
    return dt.datetime(at.year, at.month, at.day)


def follow(
    spark: SparkSession,
    raw_path: str,
    schema: T.StructType,
    target: str,
    job: Callable[..., DataFrame],
    *,
    clock: Clock,
    checkpoint: str,
    overlap: int = 0,
    note: Callable[[DataFrame], None] | None = None,
    files_per_batch: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Publish at ``target`` what the files that came to ``raw_path`` since the last call change.

    ``job(raw, since=None)`` is a job of ``refresh_days`` whose days depend on
    their own rows and on those of ``overlap`` days before.  ``note`` gets the
    rows of each batch with all columns, before its days are published, for
    state that late rows must reach too; it may get a batch again.  Rows with a
    NULL clock belong to no day.  Returns the query, ended unless ``every`` is set.
    """

    def work(batch: DataFrame, _: int) -> None:
        own = batch.sparkSession
        with scope(own):
            begin = first_day(batch, clock)
            if begin is None:
                return
            if note is not None:
                note(batch)
            raw = own.read.schema(schema).parquet(raw_path)
            if last_published_day(own, target) is None:
                publish(job(raw, since=None), target)
            else:
                publish(open_days(job, raw, clock, begin, overlap), target, begin=begin)

    source = spark.readStream.schema(schema)
    if files_per_batch is not None:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    rows = source.parquet(raw_path)
    rows = rows if note is not None else rows.select(clock.column)
    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(work)
    if every is not None:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def stored_runs(spark: SparkSession, path: str) -> DataFrame:
    """Runs appended at ``path`` by the batches so far (``operators.gaps.runs``); none is an error."""
    runs = read_if_there(spark, path)
    if runs is None:
        raise FileNotFoundError(f"no runs are stored at {path}")
    return runs
