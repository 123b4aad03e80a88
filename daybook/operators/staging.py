"""Materialise a flat fact table that several branches of a job read (§4).

The reference stores its flattened transaction and action tables before
aggregating them; here a job stages its exploded fact table once as a
parquet table written under the cluster's shared ``spark.checkpoint.dir``
and reads it back.  The per-day aggregates, exact medians and distinct
counts that follow read a narrow stored table (with column pruning) instead
of re-exploding the nested blocks, the lineage is cut, and a lost executor
never forces a recompute from the raw scan.  One write job per stage: unlike
``DataFrame.checkpoint``, nothing is computed twice.

Staged folders are removed when the ``scope`` around a job ends, after its
result is written, and otherwise when the process ends.

Set ``daybook.stage=none`` to keep everything in one lazy plan instead
(``frozen`` tables are always written: their contents must not change).
"""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Iterator

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

from daybook.session import ensure_checkpoint_dir
from daybook.sources.storage import delete

CONF_KEY = "daybook.stage"

#: Folders not yet removed: (application, path), in the order they were made.
_staged: list[tuple[str, str]] = []


def scratch_path(spark: SparkSession) -> str:
    """A new folder's path under the checkpoint folder, removed like a staged one."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/daybook-stage/{uuid.uuid4().hex}"
    if not _staged:
        atexit.register(_at_exit)
    _staged.append((spark.sparkContext.applicationId, path))
    return path


def frozen(df: DataFrame, **options: str) -> DataFrame:
    """Write ``df`` once to the checkpoint folder and read it back."""
    path = scratch_path(df.sparkSession)
    # written and read once or twice: zstd leaves about a third less to write than the default
    df.write.mode("overwrite").options(compression="zstd", **options).parquet(path)
    return df.sparkSession.read.parquet(path)


def stage(df: DataFrame) -> DataFrame:
    if df.sparkSession.conf.get(CONF_KEY, "checkpoint") == "none":
        return df
    return frozen(df)


def release(spark: SparkSession, since: int = 0) -> None:
    """Remove this application's staged folders, from the ``since``-th on."""
    own = spark.sparkContext.applicationId
    gone = [x for x in _staged[since:] if x[0] == own]
    for _, path in gone:
        delete(spark, path)
    _staged[since:] = [x for x in _staged[since:] if x not in gone]


@contextlib.contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged inside once the block ends, its result written."""
    mark = len(_staged)
    try:
        yield
    finally:
        release(spark, mark)


def _at_exit() -> None:
    active = SparkContext._active_spark_context
    session = SparkSession.getActiveSession() if active is not None else None
    if session is not None:
        with contextlib.suppress(Exception):  # the JVM may be gone already
            release(session)
