"""Exact interpolated median per group (A7, A10), one plan at every size.

``percentile_cont(0.5)`` semantics: NULLs ignored, the two middle doubles
of the group interpolated as ``lo * 0.5 + hi * 0.5`` (the same rounding as
Spark's and DuckDB's exact percentile).

Spark's exact ``percentile`` keeps every distinct value of a group in one
task.  Here a median is found in two grouped passes, neither of which brings a
group together:

1. values are counted per (group, magnitude bucket), a bucket being a 1/64 of
   a power of two; counts combine map-side, and a group has a few thousand
   buckets at most, whose running count says which ones hold the middle ranks;
2. only the values in those one or two buckets are counted by value, and the
   middle ranks are looked up in their running count.

A hot day thus spreads over all tasks in pass 1 and is cut to about 1% of its
value range in pass 2.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.operators.staging import stage

#: Buckets per power of two.
STEPS = 64
#: Offset that keeps buckets of positive values above 0 (doubles reach 2^-1074).
_ZERO = 1100 * STEPS


def _middle(lo, hi):
    return lo * F.lit(0.5) + hi * F.lit(0.5)


def _bucket(v: Column) -> Column:
    """A whole number that never falls as ``v`` rises."""
    size = F.least(F.floor(F.log2(F.abs(v)) * STEPS), F.lit(1100 * STEPS)).cast("int") + _ZERO
    return F.when(F.isnan(v), 4 * _ZERO).when(v > 0, size).when(v < 0, -size).otherwise(0)


def exact_median(df: DataFrame, keys: Sequence[str], value, name: str, *, stage_input: bool = True) -> DataFrame:
    """Return ``keys + [name]``: the exact median of ``value`` per group.

    Groups whose values are all NULL do not appear; stitch the result with a
    left join so that they read as NULL, as in SQL.
    """
    return exact_medians(df, keys, {name: value}, stage_input=stage_input)


def exact_medians(df: DataFrame, keys: Sequence[str], values: dict, *, stage_input: bool = True) -> DataFrame:
    """Exact medians of several columns of one DataFrame per group.

    The narrow (keys, values) input is read twice, so it is staged first
    (``stage_input=False`` when ``df`` is itself a staged table).
    """
    keys = list(keys)
    base = df.select(*keys, *_numbers(values))
    if stage_input:
        base = stage(base)
    return _medians(_rows(base, keys, len(values)), keys, list(values), F.count(F.lit(1)))


def value_counts(df: DataFrame, keys: Sequence[str], values: dict) -> DataFrame:
    """(keys, _i, _v, _n): how often each group has each value of the ``_i``-th of ``values``.

    Counts combine map-side, a hot value is one row a task, and counts of
    several groups add up, so stored counts of days give the medians of months.
    """
    rows = _rows(df.select(*keys, *_numbers(values)), keys, len(values))
    return rows.groupBy(*keys, "_i", "_v").agg(F.count(F.lit(1)).alias("_n"))


def medians_of_counts(counts: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """``keys + names``: exact medians out of (stored) ``value_counts`` of these or finer groups."""
    return _medians(counts.select(*keys, "_i", "_v", "_n"), list(keys), list(names), F.sum("_n"))


def _numbers(values: dict) -> list[Column]:
    return [(F.col(v) if isinstance(v, str) else v).cast("double").alias(f"_m{i}") for i, v in enumerate(values.values())]


def _rows(base: DataFrame, keys: Sequence[str], columns: int) -> DataFrame:
    """(keys, _i, _v) of the values _m0, _m1, …; NULLs left out."""
    if columns > 1:
        each = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"_m{i}").alias("v")) for i in range(columns)]))
        rows = base.select(*keys, each.alias("_e")).select(*keys, F.col("_e.i").alias("_i"), F.col("_e.v").alias("_v"))
    else:
        rows = base.select(*keys, F.lit(0).alias("_i"), F.col("_m0").alias("_v"))
    return rows.where(F.col("_v").isNotNull())


def _medians(rows: DataFrame, keys: list[str], values: list[str], number: Column) -> DataFrame:
    """Medians of the rows' values; ``number`` aggregates how many values some rows stand for."""
    rows = rows.withColumn("_b", _bucket(F.col("_v")))
    names = [*keys, "_i"]
    group = Window.partitionBy(*names)
    counts = rows.groupBy(*names, "_b").agg(number.alias("_n"))
    before = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn("_all", F.sum("_n").over(group))

    def inside(rank: Column) -> Column:
        """The rank within the bucket, NULL in other buckets."""
        return F.when((rank >= F.col("_off")) & (rank < F.col("_off") + F.col("_n")), rank - F.col("_off"))

    targets = counts.select(
        *[F.col(n).alias(f"_t{n}") for n in names],
        F.col("_b").alias("_tb"),
        inside(F.floor((F.col("_all") - 1) / 2)).alias("_lo"),
        inside(F.floor(F.col("_all") / 2)).alias("_hi"),
    ).where("_lo IS NOT NULL OR _hi IS NOT NULL")
    # Stored, so that the planner knows how small it is before it plans the second pass:
    # at most two rows a group and column, which it may send to the rows.
    targets = stage(targets)

    same = rows["_b"] == targets["_tb"]
    for n in names:  # NULL keys are groups too
        same = same & rows[n].eqNullSafe(targets[f"_t{n}"])
    near = rows.join(targets, same).groupBy(*names, "_b", "_v").agg(
        number.alias("_n"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi")
    )
    running = Window.partitionBy(*names, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("_end", F.sum("_n").over(running))

    def here(rank: str) -> Column:
        return (F.col(rank) >= F.col("_end") - F.col("_n")) & (F.col(rank) < F.col("_end"))

    found = near.where(here("_lo") | here("_hi")).groupBy(*names).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    per = found.select(*names, _middle(F.col("_lo"), F.col("_hi")).alias("_median"))
    if len(values) == 1:
        return per.select(*keys, F.col("_median").alias(values[0]))
    return per.groupBy(*keys).agg(*[F.max(F.when(F.col("_i") == i, F.col("_median"))).alias(n) for i, n in enumerate(values)])
