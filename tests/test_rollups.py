"""Distinct sets and value counts that merge: equal to counts and medians over the rows themselves."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from daybook.operators import medians_of_counts, value_counts
from daybook.operators.distinct_sets import WIDTH, address_sets, merged_sets, numbered, set_counts, side_flags


def transfers(n, seed, names=300):
    rnd = random.Random(seed)
    name = lambda: None if rnd.random() < 0.05 else f"a{int(names * rnd.random() ** 2)}"
    return [(rnd.randrange(6), name(), name(), rnd.choice([0.5, 1.0, 2.5, -3.0, rnd.random()])) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    hot = [(0, "a1", "a2", 1.0)] * 700  # a day and a pair that hold a third of all rows
    return [*transfers(1500, 1), *hot, (7, None, None, None), (8, "only", "only", float("nan"))]


def frame(spark, rows):
    return spark.createDataFrame(rows, "day int, f string, t string, v double")


def distinct(rows, group):
    out = {}
    for d, f, t, _ in rows:
        s, r = out.setdefault(group(d), (set(), set()))
        s.add(f), r.add(t)
    none = {None}
    return {k: (len(s - none), len(r - none), len((s | r) - none)) for k, (s, r) in out.items() if (s | r) - none}


def counted(sets, key):
    return {r[key]: tuple(r)[1:] for r in set_counts(sets, [key]).collect()}


def test_sets_of_days_and_of_merged_days(spark, rows):
    flags = side_flags(frame(spark, rows), ["day"], "f", "t")
    sets = address_sets(flags, ["day"], numbered(flags))
    assert counted(sets, "day") == distinct(rows, lambda d: d)
    halves = merged_sets(sets.withColumn("half", F.floor(F.col("day") / 3)), ["half"])
    assert counted(halves, "half") == distinct(rows, lambda d: d // 3)


def test_new_addresses_keep_the_numbers_of_known_ones(spark, rows):
    early, late = rows[:400], rows[400:]
    first = side_flags(frame(spark, early), ["day"], "f", "t")
    numbers = numbered(first)
    second = side_flags(frame(spark, late), ["day"], "f", "t")
    more = numbered(second, numbers)
    before, after = ({r["addr"]: r["number"] for r in x.collect()} for x in (numbers, more))
    assert before.items() <= after.items() and len(set(after.values())) == len(after)
    assert set(after) == {x for r in rows for x in r[1:3]} - {None}
    both = address_sets(first, ["day"], numbers).unionByName(address_sets(second, ["day"], more))
    assert counted(merged_sets(both, ["day"]), "day") == distinct(rows, lambda d: d)


def test_sets_beyond_one_bitmap(spark):
    ids = spark.range(3 * WIDTH).select(F.lit(1).alias("day"), F.concat(F.lit("x"), "id").alias("f"), F.lit(None).cast("string").alias("t"))
    flags = side_flags(ids, ["day"], "f", "t")
    sets = address_sets(flags, ["day"], numbered(flags))
    assert counted(sets, "day") == {1: (3 * WIDTH, 0, 3 * WIDTH)}
    assert sets.count() >= 3


def test_sets_of_nothing(spark):
    flags = side_flags(frame(spark, [(1, None, None, 1.0)]), ["day"], "f", "t")
    numbers = numbered(flags)
    assert numbers.count() == 0 and set_counts(address_sets(flags, ["day"], numbers), ["day"]).count() == 0
    assert numbered(frame(spark, [(1, "a", None, 1.0)]).select(F.col("f").alias("addr")), numbers).count() == 1


def test_medians_of_merged_counts(spark, rows):
    plain = [r for r in rows if r[0] < 7]
    counts = value_counts(frame(spark, plain), ["day"], {"m": "v", "n": F.col("v") * 2})
    halves = medians_of_counts(counts.withColumn("half", F.floor(F.col("day") / 3)), ["half"], ["m", "n"])
    for r in halves.collect():
        own = sorted(v for d, _, _, v in plain if d // 3 == r["half"])
        assert r["m"] == pytest.approx(statistics.median(own), abs=1e-12)
        assert r["n"] == pytest.approx(2 * statistics.median(own), abs=1e-12)
    assert {tuple(r) for r in value_counts(frame(spark, [(1, "", "", None)]), ["day"], {"m": "v"}).collect()} == set()


def test_sets_need_one_exchange_by_day_and_address(spark, rows):
    flags = side_flags(frame(spark, rows), ["day"], "f", "t")
    plan = merged_sets(address_sets(flags, ["day"], numbered(flags)), ["day"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
