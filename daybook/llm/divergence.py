"""Source divergence audit on run-length columns.

Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased.  A
language keeps the V terms that stand in at least ``MIN_DOCS`` of its
documents.  A group (language, source), and the language itself, gives a kept
term p = 1 + floor(SHARE (count + PRIOR) / (N + PRIOR V)), N the sum of its
counts.  Two sources differ by the sum of |p - q| over all kept terms; a
source stands out from its language by its terms with p > q.

Most counts of most groups are small and equal, so the vocabulary is put in an
order that brings equal counts together: by the language's count over all, and
inside a block of it by the groups' own counts, columns with fewest distinct
counts first.  Each group's column is then a few runs.  Two columns meet at
the union of their run boundaries, and each stretch adds |p - q| times its
length, whatever the number of terms in it.  Runs end where blocks end, which
changes no sum.

Documents are counted in the tasks that read them and leave those as one row
per group and term.  Blocks are ranges of the vocabulary of a language, with at
most about ``CELLS`` (term, source) cells; a block takes the pairs of up to
``TILE`` sources with all later ones.  All arithmetic is exact.

Cases: null text, language or source count as empty; a group without terms has
count 0 for all; a language that keeps no term has pairs with value 0; texts of
any length are cut at term boundaries into pieces of bounded size; bytes that
are no UTF-8 count as non-ASCII characters; ties rank by item; repeated rows
are documents each; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import batch_rows, ceil_div, frozen, lean, ship_package

MIN_DOCS = 30
PRIOR = 5
SHARE = 1_000_000_000
TERMS_LISTED = 50
#: (term, source) cells of one block, and sources whose pairs one task takes.
CELLS = 4_000_000
TILE = 256
#: Distinct terms that a task holds before it passes its counts on, and bytes of them.
HELD_TERMS = 200_000
HELD_BYTES = 32 << 20
PIECE = 4 << 20

_LETTERS = bytes(c if 97 <= (c | 32) <= 122 and c < 128 and chr(c).isalpha() or c >= 128 else 32 for c in range(256))
#: Bytes of a term as they are, A-Z lower-cased, all others as spaces.
TO_TERMS = bytes(_LETTERS).lower()


def term_lists(text: bytes, piece: int = PIECE) -> Iterator[list[bytes]]:
    """The terms of a text, in order, a list for each piece of about ``piece`` bytes."""
    text = text.translate(TO_TERMS)
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > piece:
            end = text.rfind(b" ", at, at + piece)
            end = end if end > at else text.find(b" ", at + piece)
            end = end if end > 0 else len(text)
        yield text[at:end].split()
        at = end


class _Held:
    """Counts of one task by group, passed on when they grow large."""

    def __init__(self):
        self.groups: dict[tuple, tuple[Counter, Counter]] = {}
        self.terms = self.bytes = 0

    def add(self, group: tuple, text: bytes) -> None:
        occurrences, documents = self.groups.setdefault(group, (Counter(), Counter()))
        seen: set[bytes] = set()
        before = len(occurrences)
        for words in term_lists(text):
            occurrences.update(words)
            seen.update(words)
        documents.update(seen)
        self.terms += len(occurrences) - before
        self.bytes += sum(map(len, seen)) if len(text) > 1 << 16 else 0

    def full(self) -> bool:
        return self.terms > HELD_TERMS or self.bytes > HELD_BYTES

    def out(self) -> Iterator[pa.RecordBatch]:
        for (lang, source), (occurrences, documents) in self.groups.items():
            n = len(occurrences)
            if n:
                terms = list(occurrences)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * n, pa.string()),
                        pa.array([source] * n, pa.string()),
                        pa.array(terms, pa.binary()),
                        pa.array([occurrences[t] for t in terms], pa.int64()),
                        pa.array([documents[t] for t in terms], pa.int64()),
                    ],
                    names=["lang", "source", "term", "n", "docs"],
                )
        self.__init__()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs), once or more per group and term."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held()
        for b in batches:
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                held.add((lang, source), text.as_py())
                if held.full():
                    yield from held.out()
        yield from held.out()

    return batch_rows(docs).mapInArrow(lean(over), "lang string, source string, term binary, n long, docs long")


def named(docs: DataFrame) -> DataFrame:
    """(lang, source, text as bytes), nulls as empty."""
    texts = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "source", "text"))
    return docs.select(*(t.alias(c) for c, t in zip(("lang", "source", "text"), texts))).withColumn("text", F.col("text").cast("binary"))


def shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """1 + floor(SHARE (count + PRIOR) / (total + PRIOR terms)), by long division in base 1000 so that int64 holds it."""
    divisor = total + PRIOR * terms
    left, whole = counts.astype(np.int64) + PRIOR, np.zeros(len(counts), np.int64)
    digits = SHARE
    while digits > 1:
        left, digits = left * 1000, digits // 1000
        whole, left = whole * 1000 + left // divisor, left % divisor
    return whole + 1


def clustered(columns: list[np.ndarray]) -> np.ndarray:
    """An order of the rows that brings equal counts together, columns with few distinct counts first."""
    by_kinds = sorted(columns, key=lambda c: len(np.unique(c)), reverse=True)
    return np.lexsort(by_kinds)  # the last key is the first to sort by


def runs(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ends, values) of the runs of equal numbers."""
    ends = np.append(np.flatnonzero(np.diff(column)) + 1, len(column))
    return ends, column[ends - 1]


def runs_apart(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> int:
    """Sum of |p - q| over two columns of runs, one product a stretch."""
    ends = np.union1d(a[0], b[0])
    gap = np.abs(a[1][np.searchsorted(a[0], ends)] - b[1][np.searchsorted(b[0], ends)])
    return int(gap @ np.diff(ends, prepend=0))


_FOUND = {"part": pa.string(), "source": pa.string(), "item": pa.binary(), "value": pa.int64()}


def _block(terms: pa.Table, groups: pa.Table) -> pa.Table:
    """Pairs of this block's sums, and each source's first terms of it; ``groups`` are all of the language, flagged where this task takes their pairs."""
    names = groups["source"].to_pylist()
    order = sorted(range(len(names)), key=lambda k: names[k].encode())
    names = [names[k] for k in order]
    totals, mine = ([groups[c].to_pylist()[k] for k in order] for c in ("total", "mine"))
    found: dict[str, list] = {c: [] for c in _FOUND}

    def add(part, source, items, values):
        for column, new in zip(found.values(), ([part] * len(items), [source] * len(items), items, values)):
            column.extend(new)

    n = terms.num_rows
    if not n:
        for i, name in enumerate(names):
            if mine[i]:
                rest = [x.encode() for x in names[i + 1 :]]
                add("pair", name, rest, [0] * len(rest))
        return pa.table({c: pa.array(found[c], kind) for c, kind in _FOUND.items()})

    vocabulary, whole = groups["terms"][0].as_py(), groups["lang_total"][0].as_py()
    profile = terms["profile"].combine_chunks()
    entry = profile.flatten()
    row = np.repeat(np.arange(n), pc.list_value_length(profile).to_numpy(zero_copy_only=False))
    at = {name: i for i, name in enumerate(names)}
    of = np.array([at[s] for s in entry.field(0).to_pylist()], np.int64)
    columns = np.zeros((len(names), n), np.int64)
    columns[of, row] = entry.field(1).to_numpy(zero_copy_only=False)
    order = clustered(list(columns[np.unique(of)]))
    columns = columns[:, order]
    lang_ends, lang_counts = runs(columns.sum(axis=0))
    lang = np.repeat(shares(lang_counts, whole, vocabulary), np.diff(lang_ends, prepend=0))
    items = [terms["term"][int(k)].as_py() for k in order]
    rank = np.empty(n, np.int64)
    rank[sorted(range(n), key=items.__getitem__)] = np.arange(n)

    coded = []
    for i in range(len(names)):
        ends, counts = runs(columns[i])
        coded.append((ends, shares(counts, totals[i], vocabulary)))
    for i, name in enumerate(names):
        if not mine[i]:
            continue
        rest = [x.encode() for x in names[i + 1 :]]
        add("pair", name, rest, [runs_apart(coded[i], other) for other in coded[i + 1 :]])
        gap = np.repeat(coded[i][1], np.diff(coded[i][0], prepend=0)) - lang
        out = np.flatnonzero((columns[i] > 0) & (gap > 0))
        out = out[np.lexsort((rank[out], -gap[out]))[:TERMS_LISTED]]
        add("term", name, [items[k] for k in out], gap[out].tolist())
    return pa.table({c: pa.array(found[c], kind) for c, kind in _FOUND.items()})


def _over_block(key: tuple, terms: pa.Table, groups: pa.Table) -> pa.Table:
    out = _block(terms, groups)
    return out.add_column(0, "lang", pa.array([groups["lang"][0].as_py()] * out.num_rows, pa.string()))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, cells: int = CELLS, tile: int = TILE) -> DataFrame:
    """(lang, source, part, item, value, rank): sources of a language by distance, and the terms that mark each source."""
    docs = named(docs)
    ship_package(docs.sparkSession)
    # dealt by (lang, term): both groupings below are clustered by it
    counted = term_counts(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    profiles = counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.collect_list(F.struct("source", "n")).alias("profile"))
    kept = frozen(profiles.where(F.col("docs") >= min_docs).drop("docs"))

    totals = kept.select("lang", F.inline("profile")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.groupBy("lang", "source").agg(F.lit(0).alias("_")).drop("_").join(totals, ["lang", "source"], "left")
    groups = frozen(groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total")))
    langs = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"), F.sum("total").alias("lang_total"))
    langs = langs.join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms")), "lang", "left").na.fill(0, ["terms"])
    langs = frozen(langs)

    blocks = ceil_div(int(langs.agg(F.sum(F.col("terms") * F.col("sources"))).first()[0] or 0), cells) + 1
    dealt = frozen(kept.repartitionByRange(blocks, "lang", "n", "term").withColumn("block", F.spark_partition_id()))
    alone = langs.select("lang", F.lit(-1).alias("block"))  # languages without terms have pairs too
    tiles = F.explode(F.expr(f"sequence(0L, (sources - 1) div {tile})")).alias("tile")
    taken = dealt.select("lang", "block").distinct().unionByName(alone).join(langs, "lang").select("lang", "block", "terms", "lang_total", tiles)
    taken = frozen(taken)
    sided = dealt.join(taken.select("lang", "block", "tile"), ["lang", "block"])
    by_source = Window.partitionBy("lang").orderBy("source")
    numbered = groups.withColumn("at", F.row_number().over(by_source) - 1)
    placed = taken.join(numbered, "lang").withColumn("mine", F.col("at").between(F.col("tile") * tile, F.col("tile") * tile + tile - 1))

    found = (
        sided.select("lang", "block", "tile", "term", "profile")
        .groupBy("lang", "block", "tile")
        .cogroup(placed.withColumnsRenamed({"block": "_block", "tile": "_tile"}).withColumn("_lang", F.col("lang")).groupBy("_lang", "_block", "_tile"))
        .applyInArrow(_over_block, "lang string, part string, source string, item binary, value long")
    )
    found = frozen(found)
    sums = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    sides = sums.select("lang", "value", F.expr("inline(array(struct(source AS source, item AS item), struct(cast(item AS string) AS source, cast(source AS binary) AS item)))"))
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    pairs = sides.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(best))
    terms = found.where("part = 'term'").select("lang", "source", "part", "item", "value").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= TERMS_LISTED)
    return pairs.unionByName(terms).withColumn("item", F.col("item").cast("string"))
