"""Language identification by cross-parsing entropy.

For each language a bounded sample of labelled text becomes a suffix
automaton.  A text is cross-parsed against it: from each position the longest
match with the sample is one phrase, the next phrase begins after it (a
character the sample lacks is a phrase of its own).  A phrase costs
log2(sample length) bits, the pointer that would encode it, and ``LENGTH_BITS``
for its length; a character the sample lacks costs as much as a phrase of the
longest sample of all, so that a short sample gains nothing by lacking it.  The
language that needs the fewest bits wins, ties go to the alphabetically first.
The score is 2**-bits of the winner over the sum for all languages.

Whole texts are parsed, in blocks of ``BLOCK`` characters that begin a new
phrase each: all blocks of a batch step through the automaton together, one
hash lookup in numpy a character and language.  Every character of the samples
has a symbol.

The fit is bounded by ``DOCS`` documents a language, drawn by a hash of their
id, and by ``LANGUAGE_CHARS`` characters: documents are taken whole in the
order of their ids until the next one would pass that bound; the first one is
always taken, and of a single text beyond the bound a passage of that length at
a hashed place.  All other rows are only counted.  Every language is learned.

Each language's automaton is built once, in a task of its own, and leaves it as
packed numpy columns; the tasks that parse get all of them as one broadcast,
which Spark drops from its workers when the next job does without.  Where the
samples together exceed ``PASS_CHARS`` characters, languages are dealt to
several passes over the texts, which are staged between passes with the best
language so far.

Cases: a null text, or one without any letter, is ``und`` with score 0; with
no labelled row at all every text is ``und``; rows with null lang or null
doc_id, and texts without any letter, teach nothing but are predicted;
repeated rows are predicted alike; further columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator
from functools import cached_property
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import batch_rows, frozen, give_back, lean, learns_from, separate_blocks, ship_package

UNDETERMINED = "und"
#: Documents of the fit a language.
DOCS = 64
#: Characters of the fit a language.
LANGUAGE_CHARS = 1 << 19
#: Characters of the samples that a Python worker holds as automata at once.
PASS_CHARS = 1 << 20
#: Characters parsed as one run; bounds the steps of a batch.
BLOCK = 512
#: Bits for the length of a phrase, the same for all languages.
LENGTH_BITS = 4
#: Characters that one table of the code point lookup covers (all of Unicode).
CODE_POINTS = 0x110000
PAD = 0
SEED = 5
#: Odd multiplier of the hash of transitions.
HASH = np.uint64(0x9E3779B97F4A7C15)
#: Tasks that build automata; the driver fetches the results of one after the other, a job each.
BUILDERS = 8


Samples = tuple[tuple[str, str], ...]
#: Language, bits and sum of shares of each text.
Best = tuple[list[str | None], list[float], list[float]]


#: States and symbols of the transitions, as state * CODE_POINTS + code point, and the states they lead to.
Edges = tuple[np.ndarray, np.ndarray]


def suffix_automaton(text: str) -> Edges:
    """The transitions of the suffix automaton of ``text``; state 0 is the root.

    One dict holds all transitions and packed columns the rest, about 150 bytes
    a character while it is built.
    """
    edges: dict[int, int] = {}
    link, length = array("i", [-1]), array("i", [0])
    symbols: list[tuple[int, ...] | int] = [()]  # of each state's transitions; a lone one as itself
    last = 0
    for s in map(ord, text):
        now = len(link)
        length.append(length[last] + 1)
        link.append(0)
        symbols.append(())
        at = last
        while at >= 0 and (key := at * CODE_POINTS + s) not in edges:
            edges[key] = now
            own = symbols[at]
            symbols[at] = s if own == () else (own, s) if type(own) is int else (*own, s)
            at = link[at]
        if at >= 0:
            to = edges[at * CODE_POINTS + s]
            if length[to] == length[at] + 1:
                link[now] = to
            else:
                copy = len(link)
                own = symbols[to]
                symbols.append(own)
                for c in (own,) if type(own) is int else own:
                    edges[copy * CODE_POINTS + c] = edges[to * CODE_POINTS + c]
                length.append(length[at] + 1)
                link.append(link[to])
                link[to] = link[now] = copy
                while at >= 0 and edges.get(key := at * CODE_POINTS + s) == to:
                    edges[key] = copy
                    at = link[at]
        last = now
    return np.fromiter(edges, np.int64, len(edges)), np.fromiter(edges.values(), np.int32, len(edges))


class SuffixAutomaton:
    """Transitions as an open hash table, on symbols from 0 to ``alphabet`` - 1.

    As no transition leads back to the root, 0 means none.  The table takes
    space by transition, so any alphabet fits.  It is made where the first text
    is parsed, which is not where the automaton is pickled, and the transitions
    themselves are let go then.
    """

    def __init__(self, edges: Edges, alphabet: int):
        self.edges, self.alphabet = edges, alphabet

    def make_table(self) -> None:
        if self.edges is None:
            return
        (keys, targets), alphabet = self.edges, self.alphabet
        self.edges = None
        self.root = np.zeros(alphabet, dtype=np.int64)
        at_root = keys < alphabet
        self.root[keys[at_root]] = targets[at_root]
        n = len(keys)
        bits = max(4, (2 * n).bit_length())  # a quarter to half of the slots are taken
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.targets = np.zeros(1 << bits, dtype=np.int32)
        slots = self._slots(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slots] < 0)
            _, first = np.unique(slots[free], return_index=True)
            first = free[first]
            self.keys[slots[first]], self.targets[slots[first]] = keys[first], targets[first]
            rest = np.ones(len(keys), dtype=bool)
            rest[first] = False
            keys, targets, slots = keys[rest], targets[rest], (slots[rest] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * HASH) >> self.shift).view(np.int64)

    def step(self, state: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The state after each symbol, 0 where there is none."""
        keys = state * self.alphabet + symbols
        slots = self._slots(keys)
        found = self.keys.take(slots)
        to = np.where(found == keys, self.targets.take(slots), 0).astype(np.int64)
        left = np.flatnonzero((found != keys) & (found >= 0))
        slots, keys = slots.take(left), keys.take(left)
        while len(left):  # next slots, for those that met another key
            slots = (slots + 1) & self.mask
            found = self.keys.take(slots)
            hit = found == keys
            to[left[hit]] = self.targets.take(slots[hit])
            more = ~hit & (found >= 0)
            left, slots, keys = left[more], slots[more], keys[more]
        return to


def plain(text: str) -> str:
    """Lower case, white-space runs as one space."""
    return " ".join(text.lower().split())


class CrossParser:
    """Automata of all languages over one alphabet."""

    def __init__(self, built: list[tuple[str, int, Edges]], longest: int = 0):
        """``built``: language, length of its sample and ``suffix_automaton`` of it.

        ``longest`` is the length of the longest sample of all passes, where there are others.
        """
        built = sorted(built, key=lambda b: b[0])
        points = [edges[0] % CODE_POINTS for _, _, edges in built]
        # symbol 0 pads, 1 is a character that no sample has; neither has transitions
        known = np.unique(np.concatenate([np.unique(p) for p in points] or [np.zeros(0, np.int64)]))
        alphabet = 2 + len(known)
        self.known = known.astype(np.int32)
        self.languages = [lang for lang, _, _ in built]
        pointers = [math.log2(max(2, n)) for _, n, _ in built]
        self.cost = np.array(pointers) + LENGTH_BITS
        self.literal = max([math.log2(max(2, longest)), *pointers]) + LENGTH_BITS
        self.automata = [
            SuffixAutomaton((keys // CODE_POINTS * alphabet + 2 + np.searchsorted(known, own), targets), alphabet)
            for (_, _, (keys, targets)), own in zip(built, points)
        ]

    @classmethod
    def of(cls, samples: Samples, longest: int = 0) -> CrossParser:
        """The parser of (language, sample text) pairs, built here."""
        texts = [(lang, plain(text)) for lang, text in samples]
        return cls([(lang, len(text), suffix_automaton(text)) for lang, text in texts], longest)

    @cached_property
    def symbol_of(self) -> np.ndarray:
        table = np.ones(CODE_POINTS, dtype=np.int32)
        table[self.known] = np.arange(2, 2 + len(self.known))
        return table

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "symbol_of"}

    def symbols(self, text: str) -> np.ndarray:
        return self.symbol_of[np.frombuffer(plain(text).encode("utf-32-le", "replace"), dtype=np.uint32)]

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrase counts, a row per text and a column per language."""
        return self.parse(texts)[0]

    def parse(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Counts of all phrases and of those that are a character the sample lacks."""
        codes = [self.symbols(t) for t in texts]
        blocks = np.array([-(-len(c) // BLOCK) for c in codes], dtype=np.int64)
        first = np.concatenate(([0], np.cumsum(blocks)))
        flat = np.full(int(first[-1]) * BLOCK, PAD, dtype=np.int32)
        for c, at in zip(codes, first):
            flat[at * BLOCK : at * BLOCK + len(c)] = c
        steps = np.ascontiguousarray(flat.reshape(-1, BLOCK).T)
        out = np.zeros((2, len(texts), len(self.automata)))
        owner = np.repeat(np.arange(len(texts)), blocks)
        for k, automaton in enumerate(self.automata):
            automaton.make_table()
            for n, counts in enumerate(self._parse(steps, automaton)):
                out[n, :, k] = np.bincount(owner, weights=counts, minlength=len(texts))
        return out[0], out[1]

    def _parse(self, steps: np.ndarray, automaton: SuffixAutomaton) -> tuple[np.ndarray, np.ndarray]:
        starts = np.zeros(steps.shape[1], dtype=np.int64)
        lacking = np.zeros(steps.shape[1], dtype=np.int64)
        state = np.zeros(steps.shape[1], dtype=np.int64)
        for symbols in steps:
            to = automaton.step(state, symbols)
            given = symbols != PAD
            starts += ((to == 0) | (state == 0)) & given
            state = np.where(to == 0, automaton.root.take(symbols), to)
            lacking += (state == 0) & given
        return starts, lacking

    def bits(self, texts: list[str]) -> np.ndarray:
        """Bits that each language needs, a row per text and a column per language."""
        phrases, lacking = self.parse(texts)
        return (phrases - lacking) * self.cost + lacking * self.literal

    def best(self, texts: list[str | None], so_far: Best | None = None) -> Best:
        """The best language of each text, its bits and the sum of 2**(its bits - bits) for all languages."""
        if not self.languages:
            return so_far or ([None] * len(texts), [math.inf] * len(texts), [0.0] * len(texts))
        bits = self.bits([t or "" for t in texts])
        least = bits.min(axis=1)
        lang = [self.languages[k] for k in bits.argmin(axis=1)]
        if so_far:
            before = np.array(so_far[1], dtype=float)
            lang = [old if kept else new for old, new, kept in zip(so_far[0], lang, before <= least)]
            least = np.minimum(before, least)
        total = np.exp2(-np.minimum(bits - least[:, None], 1000.0)).sum(axis=1)
        if so_far:
            total += np.array(so_far[2]) * np.exp2(-np.minimum(before - least, 1000.0))
        return lang, least.tolist(), total.tolist()

    def predict(self, texts: list[str | None], so_far: Best | None = None) -> tuple[list[str], list[float]]:
        lang, _, total = self.best(texts, so_far)
        ok = [lg is not None and any(map(str.isalpha, t or "")) for lg, t in zip(lang, texts)]
        return [lg if k else UNDETERMINED for lg, k in zip(lang, ok)], [1.0 / x if k else 0.0 for x, k in zip(total, ok)]


def drawn(rate: Column | float, seed: int, doc_id: str = "doc_id") -> Column:
    """True for a share ``rate`` of ids, the same ones each time."""
    return F.pmod(F.xxhash64(doc_id, F.lit(seed)), F.lit(1 << 30)) < rate * (1 << 30)


def sample_rows(docs: DataFrame, docs_per_language: int = DOCS, chars: int = LANGUAGE_CHARS) -> DataFrame:
    """(lang, doc_id, text) of about three times docs_per_language documents of each language, stored."""
    labelled = docs.where(learns_from("doc_id") & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # ids, not rows: one that repeats is drawn with all its rows or not at all
    counts = labelled.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("_n")).collect()
    rates = docs.sparkSession.createDataFrame(counts, "lang string, _n long")
    rows = labelled.select("lang", "doc_id", "text").join(F.broadcast(rates), "lang")
    rows = rows.where(drawn(3 * docs_per_language / F.col("_n"), SEED))  # a few too many, cut in sample_passes
    one = rows.groupBy("lang", "doc_id").agg(F.min("text").alias("text"))
    place = 1 + F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.length("text") - chars)
    passage = F.when(F.length("text") > chars, F.substring("text", place.cast("int"), F.lit(chars))).otherwise(F.col("text"))
    return frozen(one.withColumn("text", passage))


def sample_passes(rows: DataFrame, docs_per_language: int = DOCS, pass_chars: int = PASS_CHARS, chars: int = LANGUAGE_CHARS) -> tuple[list[dict[str, int]], int]:
    """The languages of each pass with the last doc_id of their sample, and the length of the longest sample."""
    own: dict[str, list[tuple[int, int]]] = {}
    for r in rows.select("lang", "doc_id", F.length("text").alias("n")).collect():  # ids and lengths alone
        own.setdefault(r["lang"], []).append((r["doc_id"], r["n"]))
    passes: list[dict[str, int]] = []
    held, longest = 0, 0
    for lang in sorted(own):
        in_order = sorted(own[lang])[:docs_per_language]
        ends = list(accumulate(n + 1 for _, n in in_order))
        taken = max(1, sum(end <= chars + 1 for end in ends))
        n = ends[taken - 1] - 1
        if not passes or held + n > pass_chars:
            passes.append({})
            held = 0
        passes[-1][lang] = in_order[taken - 1][0]
        held, longest = held + n, max(longest, n)
    return passes, longest


def _chosen(rows: DataFrame, languages: dict[str, int]) -> DataFrame:
    last = rows.sparkSession.createDataFrame(list(languages.items()), "lang string, _last long")
    return rows.join(F.broadcast(last), "lang").where(F.col("doc_id") <= F.col("_last")).select("lang", "doc_id", "text")


def pass_samples(rows: DataFrame, languages: dict[str, int]) -> Samples:
    """(lang, sample text) of the languages of one pass."""
    own: dict[str, list[tuple[int, str]]] = {lang: [] for lang in languages}
    for r in _chosen(rows, languages).collect():
        own[r["lang"]].append((r["doc_id"], r["text"]))
    return tuple((lang, " ".join(text for _, text in sorted(own[lang]))) for lang in sorted(own))


def pass_parser(rows: DataFrame, languages: dict[str, int], longest: int = 0) -> CrossParser:
    """The parser of one pass; a task a language builds its automaton."""
    if not languages:
        return CrossParser([], longest)

    def build(table: pa.Table) -> pa.Table:
        separate_blocks()
        texts = sorted(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()))
        sample = plain(" ".join(text for _, text in texts))
        keys, targets = suffix_automaton(sample)
        give_back()  # a task may build several languages
        return pa.table({"lang": [table["lang"][0].as_py()], "n": pa.array([len(sample)], pa.int64()), "keys": [keys.tobytes()], "targets": [targets.tobytes()]})

    ship_package(rows.sparkSession)
    built = _chosen(rows, languages).groupBy("lang").applyInArrow(build, "lang string, n long, keys binary, targets binary").coalesce(BUILDERS)
    return CrossParser([(r["lang"], r["n"], (np.frombuffer(r["keys"], np.int64), np.frombuffer(r["targets"], np.int32))) for r in built.toLocalIterator()], longest)


def language_samples(docs: DataFrame, docs_per_language: int = DOCS) -> Samples:
    """(lang, sample text) of each language, all at once."""
    rows = sample_rows(docs, docs_per_language)
    passes, _ = sample_passes(rows, docs_per_language)
    return tuple(sample for languages in passes for sample in pass_samples(rows, languages))


def identified(docs: DataFrame, keep: list[str], rows: DataFrame, pass_chars: int = PASS_CHARS) -> tuple[DataFrame, str, str]:
    """The columns ``keep`` of docs with two more, the language and its score, and the names of those two."""
    passes, longest = sample_passes(rows, pass_chars=pass_chars)
    lang, bits, total = (free_name(docs, name) for name in ("lang_pred", "bits", "score"))

    def add(docs: DataFrame, languages: dict[str, int], first: bool, last: bool) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(pass_parser(rows, languages, longest))
        own = [*keep] if last else docs.columns if first else docs.columns[:-3]

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parser = shared.value
            for batch in batches:
                texts = batch.column("text").to_pylist()
                so_far = None if first else tuple(batch.column(name).to_pylist() for name in (lang, bits, total))
                if last:
                    found = dict(zip((lang, total), parser.predict(texts, so_far)))
                else:
                    found = dict(zip((lang, bits, total), parser.best(texts, so_far)))
                more = [pa.array(values, pa.string() if name == lang else pa.float64()) for name, values in found.items()]
                yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in own), *more], names=[*own, *found])

        schema = T.StructType([docs.schema[name] for name in own]).add(lang, "string")
        schema = schema.add(total, "double") if last else schema.add(bits, "double").add(total, "double")
        return batch_rows(docs).mapInArrow(lean(work), schema)

    for k, languages in enumerate(passes[:-1]):
        docs = frozen(add(docs, languages, k == 0, False))
    return add(docs, passes[-1] if passes else {}, len(passes) <= 1, True), lang, total


def free_name(docs: DataFrame, name: str) -> str:
    while name.lower() in map(str.lower, docs.columns):
        name = f"_{name}"
    return name


def identify_language(docs: DataFrame, pass_chars: int = PASS_CHARS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of each row."""
    found, lang, score = identified(docs.select("doc_id", "text"), ["doc_id"], sample_rows(docs), pass_chars)
    return found.select("doc_id", F.coalesce(~learns_from("doc_id"), F.lit(False)).alias("held_out"), lang, score)


def keep_known_language(docs: DataFrame, pass_chars: int = PASS_CHARS) -> DataFrame:
    """The rows of ``docs`` whose language is determined, unchanged.

    That is all rows with a letter; where no row is labelled, too.
    """
    rows = sample_rows(docs)
    if rows.isEmpty():
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found, lang, _ = identified(docs, docs.columns, rows, pass_chars)
    return found.where(F.col(lang) != UNDETERMINED).select(*docs.columns)
