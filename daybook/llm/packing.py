"""Best-fit decreasing packing with a segment tree over remaining capacities.

Documents are tokenised where they lie; only (doc_id, piece, start, length,
ids_crc32) travel on.  One packing covers them all: best fit decreasing sees
nothing of a piece but its length, so the driver packs the histogram of the
lengths, at most as many rows as a sequence has tokens, whatever the corpus.

Lengths go longest first into the open bin with the tightest sufficient room.
A segment tree over the capacities 0..max finds it: a leaf counts the open
bins with exactly that much room, kept as ranges of bins, and the first
non-empty leaf at or right of the length is found in O(log max) steps.  Once a
bin is the tightest it stays so until it cannot take that length again, so a
range of n equal bins takes n times as many equal pieces in one step.

The packing says where the k-th piece of a length goes.  Pieces get their k by
a sort in ranges and carried counts, without a window over a whole length, and
look their place up in the driver's table of steps (some ten thousand).

Cases: a null text is empty and gives the one piece [0] (the end mark); only
documents beyond the limit are cut, the first piece takes the remainder;
pieces of equal length are numbered by (doc_id, piece); repeated rows are
packed as often as they occur; an empty table gives an empty result; further
columns are ignored.  With ``added_tokens`` the string of an added token of the
tokenizer file is that token, as its library has it by default (the queries
pack so); without, it is plain text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import Columns, batch_rows, ceil_div, frozen, lean, kind_of, map_columns
from daybook.llm.mixing import dealt_by_range, prefix_sums
from daybook.llm.tokens import byte_bpe, encoder

MAX_TOKENS = 2048
END_ID = 0


class CapacityTree:
    """Ranges (first bin, bins) of open bins by remaining room; finds the least room that still suffices."""

    def __init__(self, most: int):
        self.leaves = 1 << max(1, most).bit_length()
        self.count = [0] * (2 * self.leaves)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(most + 1)]

    def put(self, room: int, first: int, bins: int) -> None:
        self.ranges[room].append((first, bins))
        node = self.leaves + room
        while node:
            self.count[node] += bins
            node >>= 1

    def take(self, need: int) -> tuple[int, int, int] | None:
        """Remove and return (room, first bin, bins), a range with the tightest room of at least ``need``."""
        count, node = self.count, self.leaves + need
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):  # up to the first right sibling with bins
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.leaves
        first, bins = self.ranges[room].pop()
        while node:
            count[node] -= bins
            node >>= 1
        return room, first, bins


#: (length, number of the first piece of that length, pieces, bin of the first, offset): the pieces go to consecutive bins.
Step = tuple[int, int, int, int, int]


def best_fit_steps(histogram: dict[int, int], capacity: int) -> list[Step]:
    """Best fit decreasing of ``histogram`` (length -> pieces)."""
    tree, opened, steps = CapacityTree(capacity), 0, []
    for length, pieces in sorted(histogram.items(), reverse=True):
        done = 0

        def fill(room: int, first: int, bins: int, each: int) -> None:
            nonlocal done
            for k in range(each):
                steps.append((length, done, bins, first, capacity - room + k * length))
                done += bins
            if room > each * length:
                tree.put(room - each * length, first, bins)

        while done < pieces:
            found = tree.take(length)
            room, first, bins = found or (capacity, opened, pieces)  # new bins, as many as are needed
            each = room // length
            whole = min(bins, (pieces - done) // each)
            rest = min(1, bins - whole) * ((pieces - done) - whole * each)  # one bin takes what is left
            if whole:
                fill(room, first, whole, each)
            if rest:
                fill(room, first + whole, 1, rest)
            used = whole + (rest > 0)
            if not found:
                opened += used
            elif used < bins:
                tree.put(room, first + used, bins - used)
    return steps


def cut(length: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces; all but the first are ``most`` long."""
    first = length - (ceil_div(length, most) - 1) * most
    return [(0, first)] + [(start, most) for start in range(first, length, most)]


def pieces_of(docs: DataFrame, tokenizer: str | None = None, max_tokens: int = MAX_TOKENS, added_tokens: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32), tokenised where the documents lie."""
    docs = docs.select("doc_id", "text")

    def tokenise(batches: Iterator[Columns]) -> Iterator[Columns]:
        encode = encoder(tokenizer, added_tokens)
        try:
            for b in batches:
                out: Columns = {name: [] for name in schema}
                for doc_id, text in zip(b["doc_id"], b["text"]):
                    ids = np.array([*encode(text or ""), END_ID], dtype="<u4")
                    for k, (start, n) in enumerate(cut(len(ids), max_tokens)):
                        for name, value in zip(schema, (doc_id, k, start, n, zlib.crc32(ids[start : start + n]))):
                            out[name].append(value)
                yield out
        finally:  # the worker outlives its task and would keep the vocabulary
            byte_bpe.cache_clear()

    schema = {"doc_id": kind_of(docs, "doc_id"), "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint"}
    return map_columns(docs, tokenise, schema)


def pack(pieces: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """``pieces`` with sequence_id and offset."""
    order = ["doc_id", "piece", "ids_crc32", "_row"]
    dealt = dealt_by_range(frozen(pieces).withColumn("_row", F.monotonically_increasing_id()).withColumn("_one", F.lit(1)), ["length"], order)
    histogram = {r["length"]: r["n"] for r in dealt.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # max_tokens rows at most
    steps = np.array(best_fit_steps(histogram, max_tokens), np.int64).reshape(-1, 5)
    base = {length: k for k, length in enumerate(sorted(histogram, reverse=True))}
    key = np.array([base[length] for length in steps[:, 0].tolist()], np.int64)
    table = dealt.sparkSession.sparkContext.broadcast((sorted(histogram), key, steps))
    numbered = prefix_sums(dealt, ["length"], order, "_one").select(*pieces.columns, F.col("_start").alias("sequence_id"))
    schema = T.StructType([*numbered.schema.fields]).add("offset", "long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, key, steps = table.value
        for b in batches:
            number = b.column("sequence_id").to_numpy(zero_copy_only=False)
            own = len(lengths) - 1 - np.searchsorted(lengths, b.column("length").to_numpy(zero_copy_only=False))
            # steps are in the order of (length descending, number): find the last one that begins at or before the piece
            low, high = np.searchsorted(key, own), np.searchsorted(key, own, side="right")
            while (high - low > 1).any():
                middle = (low + high) // 2
                before = steps[middle, 1] <= number
                low, high = np.where(before, middle, low), np.where(before | (high - low <= 1), high, middle)
            at = steps[low]
            found = [pa.array(at[:, 3] + number - at[:, 1], pa.int64()), pa.array(at[:, 4], pa.int64())]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *found], schema=pa.schema([*list(b.schema)[:-1], pa.field("sequence_id", pa.int64()), pa.field("offset", pa.int64())]))

    return batch_rows(numbered).mapInArrow(lean(place), schema)


def best_fit_packing(
    docs: DataFrame,
    tokenizer: str | None = None,
    max_tokens: int = MAX_TOKENS,
    added_tokens: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of each piece."""
    return pack(pieces_of(docs, tokenizer, max_tokens, added_tokens), max_tokens)
