"""Vector code compression: product codes by exact integer products in limbs.

Components become integers floor(256 x); a vector is cut into ``PARTS`` equal
consecutive parts, each replaced by the number of its nearest codebook entry.
Codebooks start as the parts of the ``ENTRIES`` smallest ids and move to the
floored means of their parts, ``ROUNDS`` times.

Nearest means least |c|^2 - 2 x.c, first of equals, so the products must be
exact.  Integers are cut into limbs of w bits with parts x 2^(2w) <= 2^53:
every BLAS product of two limb matrices is then a sum of doubles without
rounding, and the shifted limb products are added up as int64 (as Python
integers where they could pass 62 bits).

Spark keeps the rows: a round maps batches to one partial sum per (part,
entry) and task, and adds those by (part, entry, component).  The driver and
the tasks hold codebooks only, ``ENTRIES`` vectors.

Cases: rows whose vector is null or holds null or non-finite components are
dropped; of equal ids the lesser vector is the smaller, null ids come last;
fewer than ``ENTRIES`` rows make a smaller codebook; a length that ``PARTS``
does not divide is cut as evenly as can be; vectors whose length differs from
the smallest id's, or with an integer beyond 62 bits, are kept with code and
error null; an error beyond a long is null; null labels add up together;
repeated rows are rows each; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import batch_rows, frozen, lean

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Places that the rows of one label are spread over.
SALTS = 32
_MOST_BITS = 62
_HALF = 31  # sums travel as two halves, so that a task's rows cannot overflow them


def _bits(a: np.ndarray) -> int:
    return max(int(a.max(initial=0)), -int(a.min(initial=0))).bit_length()


def limbs(a: np.ndarray, width: int) -> list[np.ndarray]:
    """Float64 limbs, least first, with a = sum of limb k x 2^(k width); all but the last in [0, 2^width)."""
    out = []
    while _bits(a) > width:
        out.append((a & ((1 << width) - 1)).astype(np.float64))
        a = a >> width
    return [*out, a.astype(np.float64)]


def exact_products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """x @ c.T for int64 matrices, exact; int64, or Python integers where 62 bits could be passed."""
    reach = max(1, x.shape[1]).bit_length()
    width = (53 - reach) // 2
    dtype = np.int64 if _bits(x) + _bits(c) + reach <= _MOST_BITS else object
    total = np.zeros((len(x), len(c)), dtype)
    right = limbs(c, width)
    for i, a in enumerate(limbs(x, width)):
        for j, b in enumerate(right):
            total += (a @ b.T).astype(np.int64).astype(dtype) * (1 << width * (i + j))
    return total


def _squares(x: np.ndarray) -> np.ndarray:
    wide = x.astype(object) if 2 * _bits(x) + max(1, x.shape[1]).bit_length() > _MOST_BITS else x
    return (wide * wide).sum(axis=1) if x.shape[1] else np.zeros(len(x), np.int64)


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of x the first nearest row of c, and its squared distance."""
    xx, cc = _squares(x), _squares(c)
    small = _bits(x) + _bits(c) + 2 + max(1, x.shape[1]).bit_length() + abs(_bits(x) - _bits(c)) <= _MOST_BITS
    dtype = np.int64 if small else object
    score = cc.astype(dtype)[None, :] - 2 * exact_products(x, c).astype(dtype)
    code = score.argmin(axis=1).astype(np.int64)
    return code, score[np.arange(len(x)), code] + xx.astype(dtype)


def part_bounds(length: int, parts: int) -> list[tuple[int, int]]:
    return list(pairwise(k * length // parts for k in range(parts + 1)))


def integer_vectors(vectors: pa.ListArray) -> tuple[np.ndarray, pa.ListArray]:
    """(rows that stay, their floor(256 x)); null in place of a vector beyond the integers."""
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    x = pc.cast(vectors.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lengths)), lengths)
    stays = vectors.is_valid().to_numpy(zero_copy_only=False).copy()
    stays[row[~np.isfinite(x)]] = False
    x, row = x[stays[row]], row[stays[row]]
    fits = np.ones(len(lengths), bool)
    large = np.abs(x) >= 2.0 ** (_MOST_BITS - 8)
    fits[row[large]] = False
    whole = np.floor(x[fits[row]] * SCALE).astype(np.int64)
    kept = np.flatnonzero(stays)
    ends = np.cumsum(np.where(fits[kept], lengths[kept], 0))
    offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32), mask=np.concatenate((~fits[kept], [False])))
    return kept, pa.ListArray.from_arrays(offsets, pa.array(whole, pa.int64()))


def with_integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v): the rows that stay, v the integers of the vector."""
    rows = vectors.select("vec_id", "label", "embedding")
    schema = T.StructType([rows.schema["vec_id"], rows.schema["label"], T.StructField("v", T.ArrayType(T.LongType()))])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, v = integer_vectors(b.column(2))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(kept)), b.column(1).take(pa.array(kept)), v], names=["vec_id", "label", "v"])

    return batch_rows(rows).mapInArrow(lean(over), schema)


def _matrix(v: pa.ListArray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows of that length, their integers)."""
    fit = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(v), length), False).to_numpy(zero_copy_only=False))
    return fit, v.take(pa.array(fit)).flatten().to_numpy(zero_copy_only=False).reshape(len(fit), length)


def _partial_sums(rows: DataFrame, books: np.ndarray, parts: int) -> DataFrame:
    """(part, entry, n, high, low) of each task: parts assigned to the entry, their sums in two halves."""
    entries, length = books.shape
    bounds = part_bounds(length, parts)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((parts, entries), np.int64)
        high, low = np.zeros((entries, length), np.int64), np.zeros((entries, length), np.int64)
        for b in batches:
            _, x = _matrix(b.column(0), length)
            for p, (start, end) in enumerate(bounds):
                code, _ = nearest(x[:, start:end], books[:, start:end])
                n[p] += np.bincount(code, minlength=entries)
                np.add.at(high[:, start:end], code, x[:, start:end] >> _HALF)
                np.add.at(low[:, start:end], code, x[:, start:end] & ((1 << _HALF) - 1))
        for p, (start, end) in enumerate(bounds):
            used = np.flatnonzero(n[p])
            lists = [pa.array(list(a[used, start:end]), pa.list_(pa.int64())) for a in (high, low)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), p, np.int32)), pa.array(used.astype(np.int32)), pa.array(n[p][used]), *lists],
                names=["part", "entry", "n", "high", "low"],
            )

    return rows.select("v").mapInArrow(over, "part int, entry int, n long, high array<long>, low array<long>")


def _moved(rows: DataFrame, books: np.ndarray, parts: int) -> np.ndarray:
    """The codebooks after one round; unused entries stay."""
    halves = _partial_sums(rows, books, parts).select("part", "entry", "n", F.posexplode(F.arrays_zip("high", "low")).alias("at", "sums"))
    sums = halves.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("sums.high").alias("high"), F.sum("sums.low").alias("low"))
    out, bounds = books.copy(), part_bounds(books.shape[1], parts)
    for r in sums.toLocalIterator():  # a codebook: ENTRIES vectors at most
        out[r["entry"], bounds[r["part"]][0] + r["at"]] = ((r["high"] << _HALF) + r["low"]) // r["n"]
    return out


def _coded(rows: DataFrame, books: np.ndarray, parts: int) -> DataFrame:
    length = books.shape[1]
    bounds = part_bounds(length, parts)
    schema = T.StructType([rows.schema["vec_id"], rows.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fit, x = _matrix(b.column(2), length)
            error, codes = np.zeros(len(fit), object), np.zeros((len(fit), parts), np.uint8)
            for p, (start, end) in enumerate(bounds):
                code, distance = nearest(x[:, start:end], books[:, start:end])
                codes[:, p] = code
                error += distance.astype(object)
            code_of, error_of = [None] * b.num_rows, [None] * b.num_rows
            for k, c, e in zip(fit.tolist(), codes, error):
                code_of[k] = c.tobytes().hex()
                error_of[k] = int(e) if e < 1 << 63 else None
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(code_of, pa.string()), pa.array(error_of, pa.int64())], names=["vec_id", "label", "code", "error"])

    return rows.select("vec_id", "label", "v").mapInArrow(lean(over), schema)


def codebook_sha256(books: np.ndarray, parts: int = PARTS) -> str:
    """Digest of all entries' decimal components by part, entry and position within the part."""
    numbers = (str(n) for start, end in part_bounds(books.shape[1], parts) for n in books[:, start:end].ravel().tolist())
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def learn_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """One entry a row, all its parts side by side; ``rows`` as ``with_integers`` gives them."""
    usable = rows.where("v is not null")
    first = usable.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    length = len(first[0]["v"]) if first else 0
    start = [r["v"] for r in first if len(r["v"]) == length]
    books = np.array(start, np.int64).reshape(len(start), length)
    for _ in range(rounds if len(books) else 0):
        books = _moved(rows, books, parts)
    return books


def encode(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, label, code, error) of the rows that stay, the codebooks)."""
    rows = frozen(with_integers(vectors))
    books = learn_codebooks(rows, parts, entries, rounds)
    if not len(books):  # nothing to assign to
        none = F.lit(None)
        return rows.select("vec_id", "label", none.cast("string").alias("code"), none.cast("long").alias("error")), books
    return _coded(rows, books, parts), books


def decode(codes: list[str], books: np.ndarray, parts: int = PARTS) -> np.ndarray:
    """The vectors that codes stand for, in integers."""
    bounds = part_bounds(books.shape[1], parts)
    picked = np.array([list(bytes.fromhex(c)) for c in codes], np.int64).reshape(len(codes), parts)
    return np.concatenate([books[picked[:, p], start:end] for p, (start, end) in enumerate(bounds)], axis=1)


def code_report(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, salts: int = SALTS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of the rows that stay.

    A label's sum meets its rows in ``salts`` places, by id, not in one.
    """
    coded, books = encode(vectors, parts, entries, rounds)
    coded = frozen(coded.withColumn("_salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(salts))))
    sums = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("_sum"))
    sums = sums.select(F.col("label").alias("_label"), F.expr("try_cast(_sum AS long)").alias("label_error"), F.explode(F.expr(f"sequence(0L, {salts - 1}L)")).alias("_place"))
    met = coded.join(sums, coded["label"].eqNullSafe(F.col("_label")) & (coded["_salt"] == F.col("_place")))
    return met.select("vec_id", "code", "error", "label_error", F.lit(codebook_sha256(books, parts)).alias("codebooks_sha256"))
