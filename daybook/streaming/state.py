"""Running state of the closed days, a bucketed Spark table each.

A dataset that depends on all history finds it here as one row a key, such as
the unspent outputs by outpoint or the totals of each address.  The table is
bucketed by that key: a refresh shuffles its own open rows alone and meets the
state bucket by bucket.  Bringing the state forward reads the days closed since
and writes it again, bucket by bucket too, without a shuffle of what is kept.

``<path>/log`` gets one row when a state has been written whole; the last row
names the folder that counts, so a write that died is never read.  One writer
at a time.  The row also lets a session without a lasting catalog declare the
table again.  ``daybook.state.buckets`` (the session's shuffle partitions if
unset) is the number of buckets of a new state.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from daybook.sources.storage import delete, qualified, read_if_there
from daybook.streaming.clocks import Clock

BUCKETS_KEY = "daybook.state.buckets"
LOG = "seq bigint, before timestamp_ntz, folder string, buckets int, columns string"


def last_write(spark: SparkSession, path: str) -> Row | None:
    """The log row of the state that counts."""
    log = read_if_there(spark, f"{path}/log")
    return None if log is None else log.orderBy(F.desc("seq")).first()


def _name(folder: str) -> str:
    return f"daybook_state_{folder.rsplit('/', 1)[1]}"


@dataclass(frozen=True)
class State:
    """``build(raw)`` gives the rows out of the raw rows of all closed days.

    ``advance(state, raw)`` takes the raw rows of the days closed since and
    gives what is kept, which must not have been shuffled, and what is added
    (None for nothing).
    """

    keys: tuple[str, ...]
    build: Callable[[DataFrame], DataFrame]
    advance: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame | None]]

    def before(self, raw: DataFrame, path: str, day: dt.datetime, clock: Clock, *, rebuild: bool = False) -> DataFrame:
        """The state of all days before ``day``, brought forward or built as needed."""
        spark = raw.sparkSession
        last = last_write(spark, path)
        if last is not None and last["before"] == day and not rebuild:
            return self._table(spark, last)
        if last is not None and last["before"] < day and not rebuild:
            buckets = last["buckets"]
            kept, added = self.advance(self._table(spark, last), clock.between(raw, last["before"], day))
        else:
            buckets = int(spark.conf.get(BUCKETS_KEY, None) or spark.conf.get("spark.sql.shuffle.partitions"))
            kept, added = None, self.build(clock.before(raw, day))
        if added is not None:
            added = added.repartition(buckets, *self.keys)
        rows = added if kept is None else kept if added is None else kept.unionByName(added)
        folder = qualified(spark, f"{path}/{uuid.uuid4().hex}")
        rows.write.format("parquet").option("compression", "zstd").bucketBy(buckets, *self.keys).sortBy(*self.keys).option("path", folder).saveAsTable(_name(folder))
        now = ((last["seq"] if last else 0) + 1, day, folder, buckets, ", ".join(f"`{c}` {kind}" for c, kind in rows.dtypes))
        written = spark.createDataFrame([now], LOG)
        written.coalesce(1).write.mode("append").parquet(f"{path}/log")
        if last is not None:
            spark.sql(f"DROP TABLE IF EXISTS {_name(last['folder'])}")
            delete(spark, last["folder"])
        return self._table(spark, written.first())

    def _table(self, spark: SparkSession, write: Row) -> DataFrame:
        name, keys = _name(write["folder"]), ", ".join(f"`{k}`" for k in self.keys)
        if not spark.catalog.tableExists(name):
            place = write["folder"].replace("'", "\\'")
            spark.sql(f"CREATE TABLE {name} ({write['columns']}) USING parquet CLUSTERED BY ({keys}) INTO {write['buckets']} BUCKETS LOCATION '{place}'")
        return spark.table(name)
