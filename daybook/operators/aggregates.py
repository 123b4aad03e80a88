"""Daily roll-ups shared by every chain.

All aggregates are built-in ``groupBy().agg()`` expressions: partial
aggregation runs map-side, so a day holding a third of all rows is still
spread over every task before the shuffle.  Exact ``countDistinct`` is
planned by Spark as a two-phase aggregation keyed by (day, address), which
also spreads a hot day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def both_sides(df: DataFrame, keys: Sequence[str], sides: Sequence, name: str = "addr") -> DataFrame:
    """UNION ALL of several address columns as one column, in one scan."""
    return df.select(*keys, F.explode(F.array(*[_col(s) for s in sides])).alias(name))


def unique_addresses(df: DataFrame, keys: Sequence[str], sides: Sequence, name: str = "addr_cnt") -> DataFrame:
    """Distinct addresses over both sides of each transfer (C1); NULL not counted."""
    keys = list(keys)
    return both_sides(df, keys, sides).groupBy(*keys).agg(F.countDistinct("addr").alias(name))


def address_counts(
    df: DataFrame,
    keys: Sequence[str],
    sender,
    receiver,
    names: Sequence[str] = ("from_cnt", "to_cnt", "addr_cnt"),
) -> DataFrame:
    """Distinct senders, distinct receivers and distinct addresses on either
    side per group, in one pass (C1, C2).

    Each transfer yields its two addresses with a side flag; one aggregation
    by (group, address) — combined map-side, spread by address even when a
    day is hot — collapses repeats, and a second one by group counts.  Three
    ``countDistinct``s would instead expand every row three times before the
    shuffle.  NULL addresses are not counted; a group whose addresses are
    all NULL gets zeros, as COUNT(DISTINCT) gives.
    """
    keys = list(keys)
    pair = F.array(
        F.struct(_col(sender).alias("a"), F.lit(1).alias("f"), F.lit(0).alias("t")),
        F.struct(_col(receiver).alias("a"), F.lit(0).alias("f"), F.lit(1).alias("t")),
    )
    per = (
        df.select(*keys, F.explode(pair).alias("s"))
        .groupBy(*keys, F.col("s.a").alias("a"))
        .agg(F.max("s.f").alias("f"), F.max("s.t").alias("t"))
    )
    known = F.col("a").isNotNull()
    return per.groupBy(*keys).agg(
        F.sum(F.when(known, F.col("f")).otherwise(0)).cast("long").alias(names[0]),
        F.sum(F.when(known, F.col("t")).otherwise(0)).cast("long").alias(names[1]),
        F.count("a").alias(names[2]),
    )


def count_rows(df: DataFrame, keys: Sequence[str], name: str = "cnt") -> DataFrame:
    """COUNT(*) by keys (A1)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def total_if(pred: Column, value=None) -> Column:
    """SUM(CASE WHEN pred THEN value ELSE 0 END) (A8); a count when value is None."""
    v = F.lit(1) if value is None else _col(value)
    return F.sum(F.when(pred, v).otherwise(F.lit(0)))


def total_where(value, pred: Column) -> Column:
    """SUM(value) FILTER (WHERE pred): NULL when no row matches."""
    return F.sum(F.when(pred, _col(value)))


def stitch(base: DataFrame, *parts: DataFrame, on, how: str = "left") -> DataFrame:
    """Join per-day (or per-day-and-asset) aggregates onto a base.

    Each side has one row per key, so the join is 1:1; the sides are a few
    thousand rows and AQE broadcasts them after measuring their size.
    """
    out = base
    for p in parts:
        out = out.join(p, on=on, how=how)
    return out


def exact_avg(value) -> Column:
    """AVG of whole numbers as a double: exact sum, one division, so that the
    result does not depend on the order of rows (A3)."""
    v = _col(value).cast("decimal(38,0)")
    return F.sum(v).cast("double") / F.count(v).cast("double")


def ratio(numer, denom) -> Column:
    """numer / NULLIF(denom, 0) in double."""
    d = _col(denom)
    return _col(numer).cast("double") / F.when(d != 0, d.cast("double"))
