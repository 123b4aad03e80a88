"""The raw column that says which day a row belongs to, and bounds on it that reach the scan."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions import epoch_seconds

PARTITION = "day"


@dataclass(frozen=True)
class Clock:
    """The raw column a row's day comes from, in seconds since the epoch (or
    thousandths, ``per_second=1000``)."""

    column: str
    per_second: int = 1

    def _at(self, day: dt.datetime):
        return F.lit(epoch_seconds(day) * self.per_second)

    def since(self, raw: DataFrame, begin: dt.datetime) -> DataFrame:
        """Rows from day ``begin`` on, by bounds that reach the scan."""
        out = raw.where(F.col(self.column) >= self._at(begin))
        if PARTITION in raw.columns:
            out = out.where(F.col(PARTITION) >= F.lit(begin.strftime("%Y-%m-%d")))
        return out

    def before(self, raw: DataFrame, end: dt.datetime) -> DataFrame:
        """Rows of the days before ``end``."""
        out = raw.where(F.col(self.column) < self._at(end))
        if PARTITION in raw.columns:
            out = out.where(F.col(PARTITION) < F.lit(end.strftime("%Y-%m-%d")))
        return out

    def between(self, raw: DataFrame, begin: dt.datetime, end: dt.datetime) -> DataFrame:
        return self.before(self.since(raw, begin), end)
