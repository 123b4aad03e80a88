"""Distinct counts that merge: sets of addresses as bitmaps of their numbers.

Each address gets a number once.  The addresses of a day are then bitmaps, one
row for every ``WIDTH`` consecutive numbers that the day touches, and the sets
of several days are merged with a bitwise or, so that exact distinct counts of
months, or of both sides together, come from stored days without their rows.

Numbers grow with the file an address was numbered in, so addresses that are
new together stand together, and a day touches few rows of old ones.  A row
takes ``WIDTH`` / 8 bytes for each set however few of its bits are on: sets pay
where days hold more than about one address in a thousand of those numbered
near it; for others store the (day, address) rows themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.operators.staging import frozen

#: Bits of one of Spark's bitmaps.
WIDTH = 1 << 15
#: Numbers that one task may give (``monotonically_increasing_id``).
TASK_SHIFT = 33
SENDERS, RECEIVERS, EITHER = "from_set", "to_set", "addr_set"


def side_flags(df: DataFrame, keys: Sequence[str], sender: str | Column, receiver: str | Column) -> DataFrame:
    """(keys, addr, f, t): each address of a group once, with flags for the sides it was on; NULL left out."""
    sides = [(sender, 1, 0), (receiver, 0, 1)]
    pair = F.array(*[F.struct((F.col(c) if isinstance(c, str) else c).alias("a"), F.lit(f).alias("f"), F.lit(t).alias("t")) for c, f, t in sides])
    each = df.select(*keys, F.explode(pair).alias("s")).where(F.col("s.a").isNotNull())
    return each.groupBy(*keys, F.col("s.a").alias("addr")).agg(F.max("s.f").alias("f"), F.max("s.t").alias("t"))


def numbered(addresses: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(addr, number) of the distinct ``addr``; those in ``known`` keep theirs, new ones get higher numbers.

    The result is stored, since numbers depend on how tasks are cut.
    """
    new = addresses.select("addr").where(F.col("addr").isNotNull()).distinct()
    base = 0
    if known is not None:
        new = new.join(known, "addr", "left_anti")
        last = known.agg(F.max("number")).first()[0]
        base = 0 if last is None else ((last >> TASK_SHIFT) + 1) << TASK_SHIFT
    given = frozen(new.select("addr", (F.monotonically_increasing_id() + F.lit(base)).alias("number")))
    return given if known is None else known.unionByName(given)


def address_sets(flags: DataFrame, keys: Sequence[str], numbers: DataFrame) -> DataFrame:
    """(keys, bucket, from_set, to_set, addr_set) of ``side_flags`` rows."""
    place = F.col("number") % WIDTH
    placed = flags.join(numbers, "addr").select(*keys, F.floor(F.col("number") / WIDTH).alias("bucket"), "f", "t", place.alias("place"))
    on = F.bitmap_construct_agg
    return placed.groupBy(*keys, "bucket").agg(
        on(F.when(F.col("f") == 1, F.col("place"))).alias(SENDERS),
        on(F.when(F.col("t") == 1, F.col("place"))).alias(RECEIVERS),
        on("place").alias(EITHER),
    )


def merged_sets(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sets of coarser groups, such as the months of days."""
    return sets.groupBy(*keys, "bucket").agg(*[F.bitmap_or_agg(name).alias(name) for name in (SENDERS, RECEIVERS, EITHER)])


def set_counts(sets: DataFrame, keys: Sequence[str], names: Sequence[str] = ("from_cnt", "to_cnt", "addr_cnt")) -> DataFrame:
    """Exact distinct counts of each group."""
    counted = zip((SENDERS, RECEIVERS, EITHER), names)
    return sets.groupBy(*keys).agg(*[F.sum(F.bitmap_count(column)).alias(name) for column, name in counted])
