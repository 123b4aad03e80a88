"""Uniform shuffle into shards of exact sizes, by a hypergeometric matrix.

With n_p rows in partition p and s_j places in shard j (equal up to one), the
numbers m_pj of rows that go from p to j in a uniformly random shuffle follow
the multivariate hypergeometric law with these margins.  So the counts are
drawn first, partition by partition, and then the rows move just once:

1. permute locally: each partition sorts its rows by a random key; position in
   that order, cut by the running sums of m_p, says the shard;
2. exchange: rows go to blocks of their shard, by a second random key;
3. permute again: a third key orders each block; the blocks' running counts
   make the slots of a shard gapless.

The driver sees one count per input partition and one row of the matrix each,
never a row.  Partitions beyond ``MAX_PARTITIONS`` are coalesced first (no
shuffle), so the matrix stays bounded.  All row work is DataFrame functions.

The row counts, the block counts and the result come from three runs over the
same input, which must split alike each time: true for stored files.  Other
inputs are written to the checkpoint folder first (``stored=False``).

Cases: a null text has size 8 and the checksum of no bytes; rows repeated or
with null ids are rows like any other; fewer rows than shards leave shards
empty; an empty table gives an empty result; an input column named shard,
slot or like a helper column (``_sh_`` ...) is replaced.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import frozen, text_or_empty

SHARDS = 24
SEED = 20_240_607
MAX_PARTITIONS = 16_384
#: Rows that share one window of the last permutation.
ROWS_PER_BLOCK = 20_000
_ROW_BITS = 33  # monotonically_increasing_id() counts a partition's rows in its low 33 bits


def hypergeometric(rng: np.random.Generator, good: int, total: int, drawn: int) -> int:
    """Good items among ``drawn`` of ``total`` without replacement, for counts of any size.

    Inverts the law over its mode plus 12 standard deviations on either side,
    beyond which less than 1e-30 of its mass lies.
    """
    low, high = max(0, drawn - (total - good)), min(good, drawn)
    if low == high:
        return low
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (total + 2)))
    share = good / total
    spread = (drawn * share * (1 - share) * (total - drawn) / max(1, total - 1)) ** 0.5
    reach = int(12 * spread) + 60
    low, high = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(low, high, dtype=np.float64)  # step k -> k + 1
    step = np.log(good - k) + np.log(drawn - k) - np.log(k + 1) - np.log(total - good - drawn + k + 1)
    weight = np.concatenate(([0.0], np.cumsum(step)))
    weight = np.cumsum(np.exp(weight - weight.max()))
    return low + int(np.searchsorted(weight, rng.random() * weight[-1], side="right"))


def communication_matrix(rows: list[int], sizes: list[int], seed: int) -> list[list[int]]:
    """m[p][j] with row sums ``rows`` and column sums ``sizes``, drawn from the uniform shuffle's law."""
    rng = np.random.default_rng(seed)
    left, matrix = list(sizes), []
    for n in rows:
        total, own = sum(left), []
        for j, places in enumerate(left):
            m = hypergeometric(rng, places, total, n)
            total, n, left[j] = total - places, n - m, places - m
            own.append(m)
        matrix.append(own)
    return matrix


def shard_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (j < rows % shards) for j in range(shards)]


def shuffle_into_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, stored: bool = True, max_partitions: int = MAX_PARTITIONS, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``docs`` with shard (0 to ``shards`` - 1) and slot (gapless from 0 in each shard)."""
    spark = docs.sparkSession
    docs = docs if stored else frozen(docs)
    docs = docs.drop("shard", "slot", "_sh_row", "_sh_part", "_sh_rank", "_sh_ends", "_sh_block", "_sh_before").coalesce(max_partitions)
    numbered = docs.withColumn("_sh_row", F.monotonically_increasing_id()).withColumn("_sh_part", F.shiftright("_sh_row", _ROW_BITS))
    counts = sorted((r["_sh_part"], r["count"]) for r in numbered.groupBy("_sh_part").count().collect())
    total = sum(n for _, n in counts)
    matrix = communication_matrix([n for _, n in counts], shard_sizes(total, shards), seed)
    ends = [{"_sh_part": p, "_sh_ends": np.cumsum(own).tolist()} for (p, _), own in zip(counts, matrix)]
    cuts = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(ends)), "array<struct<_sh_part: bigint, _sh_ends: array<bigint>>>")))

    permuted = numbered.sortWithinPartitions(F.xxhash64("_sh_row", F.lit(seed)), "_sh_row").withColumn("_sh_rank", F.monotonically_increasing_id().bitwiseAND((1 << _ROW_BITS) - 1))
    blocks = 1 + total // (shards * rows_per_block)
    dealt = (
        permuted.join(F.broadcast(cuts), "_sh_part")  # at most MAX_PARTITIONS x shards numbers
        .withColumn("shard", F.size(F.filter("_sh_ends", lambda end: end <= F.col("_sh_rank"))))
        .withColumn("_sh_block", F.pmod(F.xxhash64("_sh_row", F.lit(seed + 1)), F.lit(blocks)))
    )
    in_order = Window.partitionBy("shard").orderBy("_sh_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = frozen(dealt.groupBy("shard", "_sh_block").count())
    before = sizes.select("shard", "_sh_block", F.coalesce(F.sum("count").over(in_order), F.lit(0)).alias("_sh_before"))
    again = Window.partitionBy("shard", "_sh_block").orderBy(F.xxhash64("_sh_row", F.lit(seed + 2)), "_sh_row")
    placed = dealt.drop("_sh_ends").withColumn("_sh_rank", F.row_number().over(again)).join(before, ["shard", "_sh_block"])
    return placed.select(*docs.columns, "shard", (F.col("_sh_before") + F.col("_sh_rank") - 1).cast("long").alias("slot"))


def shard_report(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of each row, read from the dealt rows."""
    text = text_or_empty("text")
    return shuffle_into_shards(docs.select("doc_id", "text"), shards, seed).select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(dealt: DataFrame, path: str) -> None:
    """One folder a shard, its files in slot order; ``ROWS_PER_BLOCK`` slots a file at most."""
    block = F.floor(F.col("slot") / ROWS_PER_BLOCK)
    (
        dealt.withColumn("_block", block)
        .repartitionByRange("shard", "_block")
        .sortWithinPartitions("shard", "slot")
        .drop("_block")
        .write.option("maxRecordsPerFile", ROWS_PER_BLOCK)
        .partitionBy("shard")
        .parquet(path)
    )
