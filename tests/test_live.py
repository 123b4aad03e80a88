"""Live refresh by a file stream, and gaps out of runs that merge: both equal a batch run over everything."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from daybook.operators import gaps
from daybook.streaming import Clock, follow, read_published
from daybook.streaming.live import first_day

DAY = 86400
CLOCK = Clock("at")


def per_day(rows, since=None):
    days = rows.groupBy(F.timestamp_seconds(F.floor(F.col("at") / DAY) * DAY).cast("timestamp_ntz").alias("date"))
    return days.agg(F.count("v").alias("cnt"), F.sum("v").alias("v"))


def ledgers(spark, *rows):
    return spark.createDataFrame([(d * DAY + s, v) for d, s, v in rows], "at long, v int").coalesce(1)


def table(spark, path):
    return {((r["date"] - dt.datetime(1970, 1, 1)).days, r["cnt"], r["v"]) for r in read_published(spark, path).collect()}


def run(spark, root, job=per_day, **kw):
    schema = ledgers(spark, (0, 0, 0)).schema
    return follow(spark, f"{root}/raw", schema, f"{root}/t", job, clock=CLOCK, checkpoint=f"{root}/c", **kw)


def arrive(spark, root, *rows):
    ledgers(spark, *rows).write.mode("append").parquet(f"{root}/raw")


def test_late_rows_reopen_their_day(spark, scratch):
    begun = []

    def job(rows, since=None):
        begun.append(since)
        return per_day(rows)

    arrive(spark, scratch, (10, 5, 1), (11, 5, 2), (12, 5, 3))
    run(spark, scratch, job)
    arrive(spark, scratch, (12, 9, 4), (40, 0, 5))
    run(spark, scratch, job)
    assert table(spark, f"{scratch}/t") == {(10, 1, 1), (11, 1, 2), (12, 2, 7), (40, 1, 5)}
    arrive(spark, scratch, (11, 9, 7))  # late
    run(spark, scratch, job)
    assert table(spark, f"{scratch}/t") == {(10, 1, 1), (11, 2, 9), (12, 2, 7), (40, 1, 5)}
    assert begun == [None, dt.datetime(1970, 1, 13), dt.datetime(1970, 1, 12)]
    run(spark, scratch, job)  # nothing new, nothing done
    assert len(begun) == 3


def test_a_batch_that_died_runs_again(spark, scratch):
    arrive(spark, scratch, (1, 0, 1))
    run(spark, scratch)
    arrive(spark, scratch, (1, 1, 10), (3, 0, 2))
    died = []

    def job(rows, since=None):
        if not died:
            died.append(since)
            raise RuntimeError("lost")
        return per_day(rows)

    with pytest.raises(Exception, match="lost"):
        run(spark, scratch, job)
    assert table(spark, f"{scratch}/t") == {(1, 1, 1)}
    run(spark, scratch, job)
    assert table(spark, f"{scratch}/t") == {(1, 2, 11), (3, 1, 2)}


def test_files_one_at_a_time_and_rows_without_a_clock(spark, scratch):
    noted = []
    for k in (5, 3, 4):
        arrive(spark, scratch, (k, 0, k))
    spark.createDataFrame([(None, 9)], "at long, v int").coalesce(1).write.mode("append").parquet(f"{scratch}/raw")
    run(spark, scratch, lambda rows, since=None: per_day(rows.where("at IS NOT NULL")), files_per_batch=1, note=lambda b: noted.append(b.count()))
    assert table(spark, f"{scratch}/t") == {(3, 1, 3), (4, 1, 4), (5, 1, 5)} and sum(noted) == 3
    assert first_day(spark.createDataFrame([], "at long"), CLOCK) is None


def test_stream_reads_the_clock_alone(spark, scratch):
    arrive(spark, scratch, (1, 0, 1))
    seen = []
    run(spark, scratch, note=None)
    rows = spark.readStream.schema("at long, v int").parquet(f"{scratch}/raw").select("at")
    query = rows.writeStream.option("checkpointLocation", f"{scratch}/c2").foreachBatch(lambda b, _: seen.append(b.columns)).trigger(availableNow=True).start()
    query.awaitTermination()
    assert seen == [["at"]]


def by_day(df):
    return {r["date"]: r[1] for r in df.collect()}


@pytest.mark.parametrize("width", [4, 7, 1 << 20])
def test_merged_runs_give_the_gaps_of_all_ledgers(spark, width):
    rnd = random.Random(width)
    present = [i for i in range(90, 400) if rnd.random() < 0.6 and not 200 < i < 240]
    rows = [(i, dt.datetime(2020, 1, 1) + dt.timedelta(days=i // 9)) for i in present]
    rows += rows[:20]  # found twice
    make = lambda some: spark.createDataFrame(some, "index long, date timestamp_ntz")
    whole = by_day(gaps.missing_by_day(make(rows), 100, bucket_width=width))
    rnd.shuffle(rows)
    parts = [rows[k::3] for k in range(3)]  # each part fills gaps of the others
    stored = None
    for part in [*parts, parts[1]]:
        found = gaps.runs(make(part), 100, width)
        stored = found if stored is None else stored.unionByName(found)
    merged = gaps.merged_runs(stored)
    assert by_day(gaps.missing_of_runs(merged)) == whole
    assert by_day(gaps.missing_of_runs(gaps.merged_runs(merged))) == whole
    covered = sorted(i for r in merged.collect() for i in range(r["begin"], r["end"] + 1))
    assert covered == sorted({i for i, _ in rows if i >= 99})


def test_runs_of_nothing(spark):
    none = spark.createDataFrame([], "index long, date timestamp_ntz")
    assert gaps.missing_of_runs(gaps.merged_runs(gaps.runs(none, 1))).count() == 0
