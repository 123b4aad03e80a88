"""Spark session settings the jobs rely on.

All day boundaries are computed from integer epoch arithmetic, so results do
not depend on the session time zone; UTC is still pinned so that any
timestamp shown to a user reads the same everywhere.
"""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings every job assumes.  AQE re-plans joins at runtime: the many small
# per-day aggregates are stitched by broadcast only after their measured size
# is known, and skewed join partitions are split.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # a row may be a block of any number of transactions: a batch of thousands would not fit in a task
    "spark.sql.parquet.columnarReaderBatchSize": "128",
    # batches that go to Python tasks are bounded by bytes, as texts are of any length
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}

# Settings for a ledger whose rows are blocks of any number of transactions, while it is
# stored and read: a task then holds one block or a few, and not a hundred.
BLOCK_CONF = {
    # the vectorised reader fills a batch of rows at a time, whatever their size
    "spark.sql.parquet.enableNestedColumnVectorizedReader": "false",
    # transactions are grouped to blocks in memory for this many blocks a task, then by a sort that may spill
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "8",
}
# Write options for such a ledger.  Parquet looks at what it has buffered after 100 rows at first and
# then after up to 10,000; here pages and row groups end by their bytes from the first block on.
BLOCK_OPTIONS = {
    "parquet.page.size.row.check.min": "1",
    "parquet.page.size.row.check.max": "64",
    "parquet.block.size": str(16 << 20),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the jobs need to an existing session."""
    for key, value in JOB_CONF.items():
        spark.conf.set(key, value)
    return spark


@contextlib.contextmanager
def few_blocks(spark: SparkSession) -> Iterator[None]:
    """``BLOCK_CONF`` for what is run inside."""
    before = {key: spark.conf.get(key) for key in BLOCK_CONF}
    try:
        for key, value in BLOCK_CONF.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "daybook") -> SparkSession:
    """A local session for tests and benchmarks (UI off, no servers)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting a local one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is; a scratch folder is only made for local runs and tests.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):  # one process; local-cluster has several
        raise RuntimeError(
            "spark.checkpoint.dir is not set: give the cluster's shared checkpoint folder "
            "(a machine-local folder would not survive the loss of an executor)"
        )
    path = tempfile.mkdtemp(prefix="daybook-ckpt-", dir=os.environ.get("DAYBOOK_SCRATCH", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path
