"""Exact dedup by skew-safe combining, whole contents compared at each stage.

1. local: each task groups its own rows by (digest, whole text), so a text
   that a third of all rows share leaves a task as one row;
2. salted: the local winners of a digest meet in up to ``salts`` places, by
   the task they come from, again grouped by (digest, whole text);
3. global: the salt winners of a digest meet once, at most ``salts`` rows a
   text, grouped by (digest, whole text).

Every grouping key holds the text itself, so two different texts never merge,
whatever the digest.  The result carries only ids, digests and counts; rows
find their class by digest, and where a digest stands for several texts (it
never does with SHA-256, tests use a weak one) by digest and text.  Digests
with more than a ``1 / HOT`` part of all rows, less than ``HOT`` of them, are
told to all tasks, and their rows meet the class in ``salts`` places.
``drop_copies`` instead meets the row that stays by digest and id, so whole rows
move once and no group of copies gathers.

Cases: a null text counts as empty and equals other empty texts; texts that
differ in white-space runs only are equal; a null id never wins against
another id, and a class with null ids only has keep_id null; rows that repeat
both id and text are one document: the query marks each alike,
``drop_copies`` returns one of them; an empty table gives an empty result;
further columns are ignored (query) or carried (``drop_copies``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import frozen, text_or_empty

#: Runs of these characters count as one space.
WHITE_SPACE = r"[\x20\x09-\x0D]+"
SALTS = 32
HOT = 1000


def normalised(text: Column | str) -> Column:
    return F.regexp_replace(text_or_empty(text), WHITE_SPACE, " ")


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def _rows(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    rows = docs.select(F.col("doc_id").alias("_id"), normalised("text").alias("_text"))
    return rows.withColumn("_digest", digest(F.col("_text")))


def content_classes(docs: DataFrame, digest: Callable[[Column], Column] = sha256_hex, salts: int = SALTS) -> DataFrame:
    """(_digest, _text, keep_id, group_size): one row per distinct text."""
    local = _rows(docs, digest).withColumn("_salt", F.spark_partition_id() % salts)
    # the partial aggregate of this groupBy is the local stage, its exchange and final aggregate the salted one
    salted = local.groupBy("_digest", "_text", "_salt").agg(F.min("_id").alias("_id"), F.count(F.lit(1)).alias("_n"))
    # dealt by digest alone, so that the count of texts per digest needs no further exchange
    meeting = salted.drop("_salt").repartition("_digest")
    return meeting.groupBy("_digest", "_text").agg(F.min("_id").alias("keep_id"), F.sum("_n").alias("group_size"))


def _by_digest(classes: DataFrame) -> DataFrame:
    return frozen(
        classes.groupBy("_digest").agg(
            F.count(F.lit(1)).alias("_texts"), F.min("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")
        )
    )


def _shared_digests(by_digest: DataFrame) -> DataFrame | None:
    """Digests of several texts, if there are any."""
    shared = by_digest.where("_texts > 1").select("_digest")
    return None if shared.isEmpty() else shared


def with_class(docs: DataFrame, digest: Callable[[Column], Column] = sha256_hex, salts: int = SALTS, hot: int = HOT) -> DataFrame:
    """Every row of ``docs`` with _text, _digest, keep_id and group_size."""
    classes = content_classes(docs, digest, salts)
    by_digest = _by_digest(classes)
    total = by_digest.agg(F.sum("group_size")).first()[0] or 0
    often = F.col("group_size") > max(salts, total // hot)
    rows = docs.withColumn("_text", normalised("text")).withColumn("_digest", digest(F.col("_text")))
    rows = rows.drop("keep_id", "group_size", "_texts", "_salt", "_often")
    marked = rows.join(F.broadcast(by_digest.where(often).select("_digest", F.lit(True).alias("_often"))), "_digest", "left")  # less than ``hot`` digests
    marked = marked.withColumn("_salt", F.when(F.col("_often"), F.pmod(F.xxhash64("doc_id"), F.lit(salts))).otherwise(F.lit(0).cast("long"))).drop("_often")
    places = F.explode(F.when(often, F.expr(f"sequence(0L, {salts - 1}L)")).otherwise(F.array(F.lit(0).cast("long"))))
    alone = marked.join(by_digest.where("_texts = 1").select("_digest", "keep_id", "group_size", places.alias("_salt")), ["_digest", "_salt"]).drop("_salt")
    shared = _shared_digests(by_digest)
    if shared is None:
        return alone
    exact = classes.join(shared, "_digest", "left_semi")
    return alone.unionByName(rows.join(exact, ["_digest", "_text"]))


def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] = sha256_hex, salts: int = SALTS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for each row, dropped ones too."""
    return with_class(docs.select("doc_id", "text"), digest, salts).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        (F.col("_digest") if digest is sha256_hex else F.sha2("_text", 256)).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, digest: Callable[[Column], Column] = sha256_hex, salts: int = SALTS) -> DataFrame:
    """The rows that stay, one for each distinct text, with the columns of ``docs``."""
    classes = content_classes(docs, digest, salts)
    by_digest = _by_digest(classes)
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.withColumn("_ed_digest", digest(normalised("text"))).withColumn("_ed_id", as_text("doc_id"))
    stays = by_digest.where("_texts = 1").select(F.col("_digest").alias("_ed_digest"), as_text("keep_id").alias("_ed_id"))
    kept = rows.join(stays, ["_ed_digest", "_ed_id"], "left_semi").dropDuplicates(["_ed_digest", "_ed_id"])
    shared = _shared_digests(by_digest)
    if shared is not None:
        exact = classes.join(shared, "_digest", "left_semi").select(F.col("_digest").alias("_ed_digest"), as_text("keep_id").alias("_ed_id"), F.col("_text").alias("_ed_text"))
        full = ["_ed_digest", "_ed_id", "_ed_text"]
        kept = kept.unionByName(rows.withColumn("_ed_text", normalised("text")).join(exact, full, "left_semi").dropDuplicates(full).drop("_ed_text"))
    return kept.select(*docs.columns)
