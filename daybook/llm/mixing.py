"""Mixing sources to target weights by systematic sampling.

All sizes (words) together are shared among the sources by weight.  A target
stops at ``MOST`` times its source's size, and the excess is shared again by
weight until none is above.  Every document of a source then expects the same
number of copies, target / size of its source; the running sum of these
expectations, moved by one random offset, crosses whole numbers, and each
crossing emits the document once.

Within a source the running sum goes by ascending size.  The emitted words
then differ from the target by about one largest document, however many
documents there are, and no document is emitted more than ``MOST`` times.

Running sums are exact (expectations are whole multiples of 2^-30) and no
window holds a whole source: rows are dealt by range, each range adds up its
own rows, and a table of one row per range and source carries the sums over.
Rows equal in id, source and text are counted first and numbered as one run,
so not even those share a task.  The order has no partition numbers or random
draws in it: reruns agree.

Cases: a null text has no words; a null source is a source of its own, the
last one; in a source without words nothing is taken; null ids are values like
any other; rows that repeat id, source and text are rows each (``mix_plan``)
or stand for each other (``mixed``); an empty table gives an empty result; an
input column called ``copy`` is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import frozen, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
#: No document is taken more often; no target is above so many times its source.
MOST = 3
SEED = "daybook-mix-1"
#: Expected copies are whole multiples of 1 / ONE.
ONE = 1 << 30
_RUN = 1 << 20  # longest array made to repeat a row


def _source_key(source: Column) -> Column:
    """Sorts by code point, null last."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def _digest(text: Column) -> Column:
    return F.sha2(text_or_empty(text), 256)


def dealt_by_range(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``df`` stored in ranges of (group, order), numbered by _part; ``order`` must tell the rows of a group apart."""
    return frozen(df.repartitionByRange(*group, *order).withColumn("_part", F.spark_partition_id()))


def prefix_sums(dealt: DataFrame, group: list[str], order: list[str], weight: str, groups: DataFrame | None = None) -> DataFrame:
    """``dealt`` with _start: the sum of ``weight`` over the rows of its group that come before.

    Columns of ``groups`` (one row per group) come along by way of the ranges,
    so that rows never meet by group.
    """
    totals = dealt.groupBy("_part", *group).agg(F.sum(weight).alias("_total"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("_part", *group, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    before = before if groups is None else before.join(groups, group)
    inside = Window.partitionBy("_part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = dealt.withColumn("_inside", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    return rows.join(before, ["_part", *group]).withColumn("_start", F.col("_before") + F.col("_inside")).drop("_part", "_before", "_inside")


def source_targets(rows: DataFrame) -> DataFrame:
    """(_source, source_size, target, _rate, _offset) of each source; the driver sees two sums a round."""
    sizes = rows.groupBy("_source").agg(F.sum(F.col("size") * F.col("_n")).alias("source_size"))
    sizes = dealt_by_range(sizes.withColumn("_all", F.lit(0)).withColumn("_one", F.lit(1)), ["_all"], ["_source"])
    ranked = prefix_sums(sizes, ["_all"], ["_source"], "_one")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("_start") % len(WEIGHTS) + 1).cast("int"))
    sources = frozen(ranked.select("_source", "source_size", weight.cast("long").alias("_weight")))

    exact = lambda c: F.col(c).cast("decimal(38,0)")
    whole = lambda n: F.lit(str(n)).cast("decimal(38,0)")
    total, weights = (x or 0 for x in sources.agg(F.sum("source_size"), F.sum("_weight")).first())
    words, share, above, settled = total, weights, F.lit(False), None
    while share:  # share words by weight over the sources that are not at their most yet
        above = whole(MOST * share) * exact("source_size") < whole(words) * exact("_weight")
        full, gone, n = sources.where(above).agg(F.sum("source_size"), F.sum("_weight"), F.count(F.lit(1))).first()
        if n == settled:
            break
        settled, words, share = n, total - MOST * (full or 0), weights - (gone or 0)
    words, share = (words, share) if share else (0, 1)
    target = F.when(above, (MOST * F.col("source_size")).cast("double")).otherwise((F.lit(words) * F.col("_weight")).cast("double") / F.lit(float(share)))
    per_copy = (whole(words * ONE) * exact("_weight")).alias("_a"), (whole(share) * exact("source_size")).alias("_b")
    rate = F.when(F.col("source_size") == 0, 0).when(above, MOST * ONE).otherwise(F.expr("_a div _b"))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(SEED), F.col("_source"))), 1, 7), 16, 10).cast("long") * 4
    return sources.select("*", *per_copy).select("_source", "source_size", target.alias("target"), rate.cast("long").alias("_rate"), offset.alias("_offset"))


def repeated(df: DataFrame, times: Column, number: str) -> DataFrame:
    """Each row ``times`` times, numbered from 0, by arrays of at most _RUN numbers."""
    runs = df.withColumn("_times", times).where("_times > 0").withColumn("_run", F.explode(F.expr(f"sequence(0L, (_times - 1) div {_RUN})")))
    last = F.least(F.lit(_RUN), F.col("_times") - F.col("_run") * _RUN) - 1
    numbered = runs.withColumn(number, F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return numbered.withColumn(number, F.col(number) + F.col("_run") * _RUN).drop("_run", "_times")


def _crossed(start: Column, n: Column | None = None) -> Column:
    """Whole numbers crossed by the expectations of ``n`` rows (one by default) from the ``start``-th on."""
    inside = ((start % ONE) * F.col("_rate") + F.col("_offset")) % ONE
    if n is None:
        return F.shiftright(inside + F.col("_rate"), 30)
    return F.shiftright(n, 30) * F.col("_rate") + F.shiftright(inside + (n % ONE) * F.col("_rate"), 30)


def _planned(docs: DataFrame) -> DataFrame:
    """Rows equal in id, source and text as one: their number _n, rows of the source before them _start, and the source's numbers."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select("doc_id", _source_key(F.col("source")).alias("_source"), size.alias("size"), _digest(F.col("text")).alias("_digest"))
    classes = rows.groupBy("doc_id", "_source", "size", "_digest").agg(F.count(F.lit(1)).alias("_n"))
    mark = F.md5(F.concat_ws("/", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "_digest"))
    order = ["size", "_mark", "doc_id", "_digest"]
    dealt = dealt_by_range(classes.withColumn("_mark", mark), ["_source"], order)
    return prefix_sums(dealt, ["_source"], order, "_n", source_targets(dealt))


def mix_plan(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) of each row of ``docs``."""
    rows = repeated(_planned(docs), F.col("_n"), "_k")
    copies = _crossed(F.col("_start") + F.col("_k"))
    return rows.withColumn("copies", copies).select(
        "doc_id",
        F.expr("if(_source = '1', null, substr(_source, 2))").alias("source"),
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: whole rows of ``docs``, each as often as it is taken, numbered by ``copy``.

    Rows that repeat id, source and text are emitted from one of them.
    """
    key = ["doc_id", "_source", "_digest"]
    columns = [c for c in docs.columns if c != "copy"]
    one = docs.withColumn("_source", _source_key(F.col("source"))).withColumn("_digest", _digest(F.col("text"))).dropDuplicates(key)
    plan = _planned(docs).select(*(F.col(c).alias(f"_of{c}") for c in key), _crossed(F.col("_start"), F.col("_n")).alias("_copies"))
    same = one["doc_id"].eqNullSafe(F.col("_ofdoc_id")) & (one["_source"] == F.col("_of_source")) & (one["_digest"] == F.col("_of_digest"))
    return repeated(one.join(plan, same), F.col("_copies"), "copy").select(*columns, "copy")
