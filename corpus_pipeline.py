"""The corpus pipeline: five stages, each one operator over all that its predecessor kept.

Every stage but the last returns whole rows of documents, with all their
columns; the last returns the packed pieces.  Between stages rows are written
as Parquet and read again, so a lost executor costs one stage at most.

Cases: nulls, empty and repeated rows are treated as the operators state; an
empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.llm.common import table
from daybook.llm.exact_dedup import drop_copies
from daybook.llm.language_id import keep_known_language
from daybook.llm.packing import best_fit_packing
from daybook.llm.prob_minhash import drop_near_dups
from daybook.llm.toxicity import drop_toxic
from daybook.operators.staging import scratch_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language cannot be determined (no letter, or no text)."""
    return keep_known_language(docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents predicted toxic; learns from the labels of documents that are still there."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each distinct text."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each near-duplicate class."""
    return drop_near_dups(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 2048 tokens."""
    return best_fit_packing(docs, added_tokens=True)


STAGES = [
    ("language_id", language),
    ("toxicity", toxic),
    ("exact_dedup", exact),
    ("minhash_near_dedup", near),
    ("best_fit_packing", packing),
]

#: Models, signatures and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    root = scratch_path(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{k}_{name}")
        docs = spark.read.parquet(f"{root}/{k}_{name}")
    return docs
