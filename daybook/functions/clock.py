"""Chain clocks → calendar day.

Days are computed with integer arithmetic on epoch values and returned as
``timestamp_ntz`` midnights, so they do not depend on the session time zone
and stay inside whole-stage codegen.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400

# Genesis instants of chains whose clocks count from genesis,
# as epoch seconds (UTC).
LISK_GENESIS = 1464109200  # 2016-05-24 17:00:00
NEM_GENESIS = 1427587585  # 2015-03-29 00:06:25


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_div(x, d: int) -> Column:
    """Integer floor division that is exact for negative values too."""
    x = _col(x)
    return ((x - F.pmod(x, F.lit(d))) / F.lit(d)).cast("long")


def day_of_seconds(seconds) -> Column:
    """Epoch seconds → midnight of its UTC day, as timestamp_ntz."""
    days = floor_div(seconds, SECONDS_PER_DAY).cast("int")
    return F.date_from_unix_date(days).cast("timestamp_ntz")


def epoch_seconds(day) -> int:
    """Epoch seconds of a naive UTC datetime, for plain bounds on raw clocks."""
    return int((day - datetime(1970, 1, 1)).total_seconds())


def day_of_millis(millis) -> Column:
    """Epoch milliseconds → midnight of its UTC day."""
    return day_of_seconds(floor_div(millis, 1000))


def seconds_or_millis(t) -> Column:
    """Values at or above 10^12 are milliseconds; truncate them to seconds."""
    t = _col(t)
    return F.when(t >= F.lit(10**12), (t / F.lit(1000)).cast("long")).otherwise(t)


def day_since(offset_seconds, genesis: int) -> Column:
    """Seconds since a chain's genesis → UTC day."""
    return day_of_seconds(_col(offset_seconds) + F.lit(genesis))


def time_of_seconds(seconds) -> Column:
    """Epoch seconds → timestamp_ntz (the sync-log clock, C25)."""
    return F.timestamp_add("SECOND", _col(seconds), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def day_text(day) -> Column:
    """Day as 10-character text, as used in CSV exports."""
    return F.date_format(_col(day), "yyyy-MM-dd")
