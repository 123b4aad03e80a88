"""Existence and removal of stored folders, through Spark's own file systems.

The only place that reaches behind the DataFrame API (Spark has no call to
delete a folder); it needs a classic session, as the package's other uses of
the SparkContext do.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at ``path``, or None when there are no data files.

    Judged by data files alone: ``_SUCCESS`` marks are often off on object stores.
    """
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ABSENT:
            return None
        raise


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its file system, which a table's location needs."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(target).toString()


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder and all in it; nothing happens when it is not there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
