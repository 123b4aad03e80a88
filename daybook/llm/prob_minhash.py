"""Near-dedup of texts: ProbMinHash signatures, banding, exact verification.

Shingles are five consecutive words, weighted by how often they occur in the
text.  The similarity is the probability Jaccard index of the weights

    J(A, B) = sum over d in both of 1 / sum over e of max(a_e / a_d, b_e / b_d),

which is the plain Jaccard index of the shingle sets where no shingle repeats.

* Signatures: each shingle runs a Poisson process whose rate is its weight; an
  arrival falls on a random register, and each register keeps the shingle that
  arrives first.  A shingle stops once its next arrival is later than the
  latest register, so long texts cost little more than one arrival a shingle.
  Two texts agree in a register with probability J.
* Banding: ``BANDS`` bands of ``ROWS`` registers; texts that agree in a band
  meet in a bucket.  A pair at J = 0.8 is missed with probability 0.0007.
* Verification: J is computed from the whole shingle tables of both texts.

Equal texts become one node first.  A bucket never yields all its pairs: each
node is compared with one delegate, links are joined into components, and only
buckets with several components are looked at further, first through
delegates (``STARS`` rounds), then by tiles of about ``TILE_ROWS`` members and
``TILE_SHINGLES`` shingles at most: one task compares all members of different
components in a pair of tiles and returns a spanning forest of the links it
finds, never the pairs.  So no link that could change a class is lost.

Words are runs of letters, marks and digits in lower case.

Cases: a text with fewer than five words is one shingle; a null text or one
without words links with nothing; texts with the same words are one class;
repeated rows and rows that repeat an id are members like any other; a null id
names a class only if all its members' are null; of members with the least id
one text stays, the one with the least digest; an empty table gives an empty
result; further columns are ignored (query) or carried (``drop_near_dups``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import Columns, batch_rows, frozen, kind_of, map_columns, separate_blocks, text_or_empty
from daybook.llm.components import connected_components, least_labels

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 24, 6
STARS = 2
TILE_ROWS = 2048
#: Distinct shingles of a tile's texts; a task holds two tiles, at about 70 bytes a shingle.
TILE_SHINGLES = 1 << 20
#: Shingles in one incidence block of a tile.
COLUMNS = 4096
REMEMBERED = 150_000

_GOLDEN = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
NOT_WORD = r"[^\p{L}\p{M}\p{N}]+"


def words_of(text: Column | str) -> Column:
    """The text's words, one space between them."""
    return F.trim(F.regexp_replace(F.lower(text_or_empty(text)), NOT_WORD, " "))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift rounds) over an array."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_tables(texts: list[str], hashes: WordHashes, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, count, text no.) of the distinct shingles of all texts, sorted by text, then hash."""
    flat: list[int] = []
    sizes = []
    for text in texts:
        own = text.split(" ") if text else []
        own = list(map(hashes.__getitem__, own))
        if own:
            own += [0] * (words - len(own))
        flat += own
        sizes.append(len(own))
    w = np.array(flat, dtype=np.uint64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    if not len(w):
        return w, np.zeros(0, dtype=np.int64), owner
    n = len(w) - words + 1
    s = np.zeros(n, dtype=np.uint64)
    for k in range(words):
        s = mix(s * np.uint64(_GOLDEN) + w[k : k + n])
    inside = owner[:n] == owner[words - 1 :]
    s, owner = s[inside], owner[:n][inside]
    order = np.lexsort((s, owner))
    s, owner = s[order], owner[order]
    first = np.flatnonzero(np.concatenate(([True], (s[1:] != s[:-1]) | (owner[1:] != owner[:-1]))))
    return s[first], np.diff(np.append(first, len(s))), owner[first]


def prob_minhash(shingles: np.ndarray, weights: np.ndarray, owner: np.ndarray, texts: int, size: int) -> np.ndarray:
    """Signatures, a row per text: in each register the shingle that arrives first."""
    arrival, winner = np.full(texts * size, np.inf), np.zeros(texts * size, dtype=np.uint64)
    latest = np.full(texts, np.inf)
    clock = np.zeros(len(shingles))
    active, turn = np.arange(len(shingles)), 0
    while len(active):
        turn += 1
        draw = mix(shingles[active] + np.uint64(turn * _GOLDEN & _MASK))
        now = clock[active] - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weights[active]
        early = now < latest[owner[active]]
        active, now, draw = active[early], now[early], draw[early]
        clock[active] = now
        register = owner[active] * size + (mix(draw + np.uint64(_GOLDEN)) % np.uint64(size)).astype(np.int64)
        np.minimum.at(arrival, register, now)
        won = arrival[register] == now
        winner[register[won]] = shingles[active[won]]
        left = owner[active]
        left = left[np.concatenate(([True], left[1:] != left[:-1]))] if len(left) else left
        latest[left] = arrival.reshape(texts, size)[left].max(axis=1)
    return winner.reshape(texts, size)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(signatures), bands), dtype=np.uint64)
    for b in range(bands):
        key = np.full(len(signatures), b + 1, dtype=np.uint64)
        for r in range(b * rows, (b + 1) * rows):
            key = mix(key * np.uint64(_GOLDEN) + signatures[:, r])
        keys[:, b] = key
    return keys.view(np.int64)


def probability_jaccard(sa: np.ndarray, a: np.ndarray, sb: np.ndarray, b: np.ndarray) -> float:
    """J of two shingle tables (hashes sorted, counts).

    With t = a/b, all shared shingles of equal t have the same denominator:
    the a-weight of shingles with ratio t or more plus t times the b-weight of the rest.
    """
    _, ia, ib = np.intersect1d(sa, sb, assume_unique=True, return_indices=True)
    if not len(ia):
        return 0.0
    wa, wb = a[ia].astype(np.float64), b[ib].astype(np.float64)
    only_a, only_b = float(a.sum() - wa.sum()), float(b.sum() - wb.sum())
    ratio, group = np.unique(wa / wb, return_inverse=True)
    ga, gb = np.bincount(group, weights=wa), np.bincount(group, weights=wb)
    at_least = only_a + np.cumsum(ga[::-1])[::-1]
    below = only_b + np.cumsum(gb) - gb
    return float((ga / (at_least + ratio * below)).sum())


def signed(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, digest, bands) of each row; digest null for texts without words."""
    given = docs.select("doc_id", words_of("text").alias("words"))
    given = given.withColumn("digest", F.when(F.col("words") != "", F.unhex(F.substring(F.sha2("words", 256), 1, 32))))

    def work(batches: Iterator[Columns]) -> Iterator[Columns]:
        hashes = WordHashes()
        for b in batches:
            distinct = {d: t for d, t in zip(b["digest"], b["words"]) if d is not None}
            shingles, counts, owner = shingle_tables(list(distinct.values()), hashes, words)
            keys = band_keys(prob_minhash(shingles, counts.astype(np.float64), owner, len(distinct), bands * rows), bands, rows)
            at = {d: k for k, d in enumerate(distinct)}
            yield {"doc_id": b["doc_id"], "digest": b["digest"], "bands": [None if d is None else keys[at[d]] for d in b["digest"]]}

    return map_columns(given, work, {"doc_id": kind_of(given, "doc_id"), "digest": "binary", "bands": "array<bigint>"})


def tables_of(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, shingles, counts) of ``nodes`` (node, digest, rep_id), read from whole texts."""
    given = docs.select(F.col("doc_id").alias("rep_id"), words_of("text").alias("words"))
    given = given.withColumn("digest", F.unhex(F.substring(F.sha2("words", 256), 1, 32)))
    same = given["digest"] == nodes["digest"]
    found = given.join(nodes, same & given["rep_id"].eqNullSafe(nodes["rep_id"])).select("node", "words").dropDuplicates(["node"])

    def work(batches: Iterator[Columns]) -> Iterator[Columns]:
        hashes = WordHashes()
        for b in batches:
            shingles, counts, owner = shingle_tables(b["words"], hashes, words)
            cut = np.searchsorted(owner, np.arange(len(b["words"]) + 1))
            counts = counts.astype("<u4")
            yield {
                "node": b["node"],
                "shingles": [shingles[i:j].tobytes() for i, j in zip(cut, cut[1:])],
                "counts": [counts[i:j].tobytes() for i, j in zip(cut, cut[1:])],
            }

    return map_columns(found, work, {"node": "bigint", "shingles": "binary", "counts": "binary"})


def verified(pairs: DataFrame, tables: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts reach the threshold."""
    left = tables.select(F.col("node").alias("a"), F.col("shingles").alias("sa"), F.col("counts").alias("ca"))
    right = tables.select(F.col("node").alias("b"), F.col("shingles").alias("sb"), F.col("counts").alias("cb"))

    def work(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            out: Columns = {"a": [], "b": []}
            for a, b, sa, ca, sb, cb in zip(*(batch[k] for k in ("a", "b", "sa", "ca", "sb", "cb"))):
                j = probability_jaccard(np.frombuffer(sa, "<u8"), np.frombuffer(ca, "<u4"), np.frombuffer(sb, "<u8"), np.frombuffer(cb, "<u4"))
                if j >= threshold:
                    out["a"].append(a)
                    out["b"].append(b)
            yield out

    both = pairs.join(left, "a").join(right, "b")
    return frozen(map_columns(both, work, {"a": "bigint", "b": "bigint"}))


def _ordered(x: Column, y: Column) -> list[Column]:
    return [F.greatest(x, y).alias("a"), F.least(x, y).alias("b")]


def _split_buckets(members: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The components (key, root, delegate) in each bucket, and the largest
    one (key, main_root, main_delegate) of those with several."""
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    parts = placed.groupBy("key", "root").agg(F.min("node").alias("delegate"), F.count(F.lit(1)).alias("n"))
    main = parts.groupBy("key").agg(F.max(F.struct("n", "root", "delegate")).alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    return parts, main.select("key", F.col("main.root").alias("main_root"), F.col("main.delegate").alias("main_delegate"))


def _delegate_pairs(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(a, b): the least node of each component in a bucket with that of the largest one."""
    parts, main = _split_buckets(members, roots)
    return parts.join(main, "key").where("root != main_root").select(*_ordered(F.col("delegate"), F.col("main_delegate"))).distinct()


def links_in_bucket(tables: list[tuple[np.ndarray, np.ndarray]], first: np.ndarray, root: np.ndarray, threshold: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) at or above the threshold whose roots differ: all of
    one tile's where all are ``first``, else those between the two tiles.

    Shared shingles are counted by products of incidence blocks.  Without
    repeated shingles these counts give J itself.  With some,
    J <= min(share of a, share of b) that lies in shared shingles says which
    pairs to compute in full.
    """
    n = len(tables)
    sizes = np.array([len(s) for s, _ in tables])
    owner = np.repeat(np.arange(n), sizes)
    _, shingle, often = np.unique(np.concatenate([s for s, _ in tables]), return_inverse=True, return_counts=True)
    weight = np.concatenate([c / c.sum() for _, c in tables])
    plain = np.array([c.max(initial=1) == 1 for _, c in tables])
    shared = often[shingle] > 1
    column = np.cumsum(often > 1)[shingle[shared]] - 1
    row, weight = owner[shared], weight[shared]
    order = np.argsort(column, kind="stable")
    column, row, weight = column[order], row[order], weight[order]
    part = np.zeros((n, n), dtype=np.float32)  # part[i, j]: the share of i's weight in shingles that j has too
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        i, j = np.searchsorted(column, [low, low + COLUMNS])
        has, of = np.zeros((n, COLUMNS), dtype=np.float32), np.zeros((n, COLUMNS), dtype=np.float32)
        has[row[i:j], column[i:j] - low] = 1
        of[row[i:j], column[i:j] - low] = weight[i:j]
        part += of @ has.T
    bound = (np.minimum(part, part.T) >= threshold - 1e-4) & (root[:, None] != root[None, :])
    if first.all():  # a tile with itself
        bound = np.triu(bound, 1)
    else:
        bound &= first[:, None] & ~first[None, :]
    i, j = np.nonzero(bound)
    common = np.rint(part[i, j] * sizes[i])
    sure = common / (sizes[i] + sizes[j] - common) >= threshold
    for k in np.flatnonzero(~(plain[i] & plain[j])):
        sure[k] = probability_jaccard(*tables[i[k]], *tables[j[k]]) >= threshold
    return [(i[sure], j[sure])]


def bucket_links(
    members: DataFrame, roots: DataFrame, tables: DataFrame, threshold: float, tile_rows: int = TILE_ROWS, tile_shingles: int = TILE_SHINGLES
) -> DataFrame:
    """(a, b): links between different components of a bucket, a spanning
    forest of them for each pair of a bucket's tiles."""
    _, main = _split_buckets(members, roots)
    split = members.join(main.select("key"), "key").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = tables.select("node", (F.octet_length("shingles") / 8).alias("size"))
    split = frozen(split.select("key", "node", "root").join(sizes, "node"))
    enough = F.greatest(F.ceil(F.count(F.lit(1)) / tile_rows), F.ceil(F.sum("size") / tile_shingles), F.lit(1))
    tiles = split.groupBy("key").agg(enough.cast("int").alias("tiles"))
    dealt = split.join(tiles, "key").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    paired = paired.select("key", "node", "root", F.least("tile", "other").alias("x"), F.greatest("tile", "other").alias("y"), (F.col("tile") <= F.col("other")).alias("first"))

    def work(group: pa.Table) -> pa.Table:
        separate_blocks()
        node, root, first = (group[k].to_numpy(zero_copy_only=False) for k in ("node", "root", "first"))
        own = [(np.frombuffer(s.as_py(), "<u8"), np.frombuffer(c.as_py(), "<u4")) for s, c in zip(group["shingles"], group["counts"])]
        links = links_in_bucket(own, first, root, threshold)
        least = least_labels(len(node), links)
        moved = np.flatnonzero(least != np.arange(len(node)))
        return pa.table({"a": pa.array(node[moved], pa.int64()), "b": pa.array(node[least[moved]], pa.int64())})

    rows = batch_rows(paired.join(tables, "node"))
    return frozen(rows.groupBy("key", "x", "y").applyInArrow(work, "a long, b long"))


def near_dup_links(members: DataFrame, tables: DataFrame, threshold: float, stars: int = STARS) -> DataFrame:
    """(node, root) of linked nodes; ``members`` (key, node) are the buckets with several nodes."""
    least = members.groupBy("key").agg(F.min("node").alias("b"))
    first = members.join(least, "key").groupBy("node").agg(F.min("b").alias("b")).where("b < node")
    checked = frozen(first.select(F.col("node").alias("a"), "b"))
    roots = connected_components(verified(checked, tables, threshold))
    for step in range(stars + 1):
        if step < stars:
            pairs = frozen(_delegate_pairs(members, roots).join(checked, ["a", "b"], "left_anti"))
            links = verified(pairs, tables, threshold)
            checked = checked.union(pairs)
        else:
            links = bucket_links(members, roots, tables, threshold)
        if not links.isEmpty():
            roots = connected_components(roots.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")).union(links))
    return roots


def _classified(docs: DataFrame, threshold: float, words: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, digest, class_id, class_size, kept) of each row."""
    base = frozen(signed(docs, words, bands, rows))
    same = base.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("rep_id"), F.count(F.lit(1)).alias("n"), F.first("bands").alias("bands"))
    nodes = frozen(same.withColumn("node", F.monotonically_increasing_id()))
    keys = nodes.select("node", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    members = frozen(keys.join(shared, "key"))
    met = nodes.join(members.select("node").distinct(), "node").select("node", "digest", "rep_id")
    roots = near_dup_links(members, frozen(tables_of(docs, met, words)), threshold)
    rooted = nodes.select("digest", "node", "rep_id", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = F.min(F.struct(F.col("rep_id").isNull(), "rep_id", "digest"))
    named = rooted.groupBy("root").agg(first.alias("first"), F.sum("n").alias("class_size"))
    classes = rooted.join(named, "root").select(
        "digest", F.col("first.rep_id").alias("class_id"), "class_size", (F.col("digest") == F.col("first.digest")).alias("stays")
    )
    result = base.select("doc_id", "digest").join(classes, "digest", "left")
    alone = F.col("digest").isNull()
    return result.select(
        "doc_id",
        "digest",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
        (alone | F.col("stays") & F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept"),
    )


def near_dup_classes(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, class_id, class_size, kept) of each row; class_id is the least doc_id of its class."""
    return _classified(docs, threshold, words, bands, rows).drop("digest")


def drop_near_dups(docs: DataFrame) -> DataFrame:
    """One row of each class, that of the least id, with the columns of ``docs``; texts without words all stay.

    Rows are told apart by id and words, so neither an id that repeats nor a
    null one takes another text along.
    """
    id_, digest = F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.unhex(F.substring(F.sha2("_nd_words", 256), 1, 32))
    classes = frozen(_classified(docs, THRESHOLD, WORDS, BANDS, ROWS).where("digest IS NOT NULL").withColumn("_nd_id", id_))
    gone = classes.where("NOT kept").select("_nd_id", F.col("digest").alias("_nd_digest")).distinct()
    rows = docs.withColumn("_nd_words", words_of("text")).withColumn("_nd_digest", F.when(F.col("_nd_words") != "", digest))
    rows = rows.drop("_nd_words").withColumn("_nd_id", id_).join(gone, ["_nd_id", "_nd_digest"], "left_anti")
    repeated = classes.where("kept").groupBy("_nd_id", F.col("digest").alias("_nd_digest")).count().where("count > 1").drop("count")
    repeated = frozen(repeated)
    if not repeated.isEmpty():  # rows equal in id and words
        once = rows.join(repeated, ["_nd_id", "_nd_digest"]).dropDuplicates(["_nd_id", "_nd_digest"])
        rows = rows.join(repeated, ["_nd_id", "_nd_digest"], "left_anti").unionByName(once)
    return rows.select(*docs.columns)
