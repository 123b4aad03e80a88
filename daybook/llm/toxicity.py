"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents (label 1) and a sample of all documents, unlabelled,
train a logistic model in numpy on the class-prior-corrected risk

    prior * P[loss(+)] + max(0, U[loss(-)] - prior * P[loss(-)]),

where P and U are means over the positive and the unlabelled sample.  Where
the second part turned negative the model would fit the positives hidden among
the unlabelled as negatives; the bound stops it there.  The prior is the share
of ones among the labels that may be learned from.

With the logistic loss, loss(+) - loss(-) is linear in the score, so the risk
without the bound is convex, and so is its maximum with prior * P[loss(+)]: the
risk has one least point, whatever the order of rows or the start.  It is the
largest over s in [0, 1] of the least prior * P[loss(+)] + s * (second part);
Newton steps find the inner one, a bracket on s the outer one, until the
gradient is below ``TOLERANCE``.

Features are the 4- and 5-character pieces of a document's words, with marks
at the word's ends, as present or absent, so length does not dilute a single
abusive word.  Of all pieces, hashed, the ``FEATURES`` whose document rates
differ most between P and U (by z-score, ``LEAST_Z`` at least) are kept.

The fit is bounded: ``POSITIVES`` toxic and ``UNLABELLED`` other documents,
drawn by a hash of their id.  Whole texts are read in fitting and scoring.

Cases: a null or empty text has no features and gets the model's base score;
without any learnable toxic label all scores are 0; several labels of a
document count as toxic if one does, null labels not at all; repeated rows are
scored alike; further columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import Columns, batch_rows, frozen, lean, kind_of, learns_from, map_columns
from daybook.llm.language_id import drawn

#: Bounds of the fit.
POSITIVES, UNLABELLED, FEATURES = 3000, 6000, 1024
THRESHOLD = 0.3
#: Least z-score of a kept piece; among some hundred thousand pieces without a message few reach it by chance.
LEAST_Z = 4.5
HASH_BITS = 22
#: Largest entry of the gradient at which the fit ends.
TOLERANCE = 1e-7
#: Weight decay times the number of positives: one Gaussian prior on the weights, whatever the sample's size.
DECAY = 1.0
SEED = 6
#: Words whose pieces a worker remembers.
REMEMBERED = 100_000

WORD = re.compile(r"\w+")


def pieces(word: str) -> set[int]:
    """Hashed 4- and 5-character pieces of a word between end marks."""
    marked = f"<{word}>"
    cut = {marked[k : k + n] for n in (4, 5) for k in range(max(1, len(marked) - n + 1))}
    return {zlib.crc32(p.encode("utf-8", "replace")) & ((1 << HASH_BITS) - 1) for p in cut}


class Extractor:
    """The features of a text, by its distinct words; ``known`` limits and numbers them."""

    def __init__(self, known: dict[int, int] | None = None):
        self.known, self.seen = known, {}

    def word(self, word: str) -> tuple[int, ...]:
        found = self.seen.get(word)
        if found is None:
            if len(self.seen) >= REMEMBERED:
                self.seen.clear()
            own = pieces(word)
            found = tuple(own) if self.known is None else tuple(self.known[p] for p in own if p in self.known)
            self.seen[word] = found
        return found

    def __call__(self, text: str | None) -> list[int]:
        out: set[int] = set()
        for word in set(WORD.findall((text or "").lower())):
            out.update(self.word(word))
        return sorted(out)


#: The numbers of the features that each document has.
Rows = list[list[int]]


def _sigmoid(g: np.ndarray) -> np.ndarray:
    return np.exp(-np.logaddexp(0, -g))


class PuRisk:
    """Corrected risk over a positive and an unlabelled sample; weights w, the bias last.

    Documents have few of the features, so only those are stored: (row, feature) pairs.
    """

    def __init__(self, positive: Rows, unlabelled: Rows, features: int, prior: float, decay: float = DECAY):
        rows = [*positive, *unlabelled]
        self.n, self.features = len(rows), features
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])
        self.feature = np.fromiter((f for r in rows for f in r), np.int64, len(self.row))
        n_p, n_u = len(positive), len(unlabelled)
        self.of_p = np.concatenate([np.full(n_p, prior / max(1, n_p)), np.zeros(n_u)])
        self.of_u = np.concatenate([np.zeros(n_p), np.full(n_u, 1 / max(1, n_u))])
        self.decay = np.append(np.full(features, decay / max(1, n_p)), 1e-9)

    def scores(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.feature], minlength=self.n) + w[-1]

    def by_feature(self, of_row: np.ndarray) -> np.ndarray:
        """Sums of a number per row over the rows that have each feature, and over all rows."""
        return np.append(np.bincount(self.feature, weights=of_row[self.row], minlength=self.features), of_row.sum())

    def parts(self, w: np.ndarray) -> tuple[float, float]:
        """prior * P[loss(+)] with the weight decay, and U[loss(-)] - prior * P[loss(-)]."""
        g = self.scores(w)
        return float(self.of_p @ np.logaddexp(0, -g) + 0.5 * self.decay @ (w * w)), float((self.of_u - self.of_p) @ np.logaddexp(0, g))

    def risk(self, w: np.ndarray) -> float:
        first, second = self.parts(w)
        return first + max(0.0, second)

    def _value(self, w: np.ndarray, s: float) -> float:
        first, second = self.parts(w)
        return first + s * second

    def gradient(self, w: np.ndarray, s: float) -> np.ndarray:
        """Of the first part and ``s`` times the second."""
        p = _sigmoid(self.scores(w))  # loss(+) = log(1 + e^-g) has slope p - 1, loss(-) = log(1 + e^g) slope p
        return self.by_feature(self.of_p * (p - 1) + s * (self.of_u - self.of_p) * p) + self.decay * w

    def least(self, w: np.ndarray, s: float, tolerance: float) -> np.ndarray:
        """The least point for a fixed ``s``, by Newton steps with conjugate gradients inside."""
        for _ in range(100):
            grad = self.gradient(w, s)
            size = np.abs(grad).max()
            if size <= tolerance:
                break
            p = _sigmoid(self.scores(w))
            curve = ((1 - s) * self.of_p + s * self.of_u) * p * (1 - p)
            step = self._solve(curve, -grad, min(0.1, size**0.5) * np.linalg.norm(grad))
            now, slope, t = self._value(w, s), grad @ step, 1.0
            while t > 1e-10 and self._value(w + t * step, s) > now + 1e-4 * t * slope + 1e-15:
                t /= 2
            w = w + t * step
        return w

    def _solve(self, curve: np.ndarray, b: np.ndarray, close: float) -> np.ndarray:
        """(x' diag(curve) x + diag(decay))^-1 b, by its diagonal's preconditioned conjugate gradients."""
        scale = self.by_feature(curve) + self.decay
        out, left = np.zeros_like(b), b.copy()
        z = left / scale
        way, inner = z.copy(), left @ z
        for _ in range(500):
            ahead = self.by_feature(curve * self.scores(way)) + self.decay * way
            a = inner / (way @ ahead)
            out += a * way
            left -= a * ahead
            if np.linalg.norm(left) <= close:
                break
            z = left / scale
            inner, before = left @ z, inner
            way = z + inner / before * way
        return out


def fit_nnpu(positive: Rows, unlabelled: Rows, features: int, prior: float, decay: float = DECAY, tolerance: float = TOLERANCE) -> tuple[np.ndarray, float]:
    """(weights, bias) of the logistic model with the least non-negative PU risk.

    Rows are put in one order first, so that sums are the same to the last bit
    however they came.
    """
    risk = PuRisk(sorted(positive), sorted(unlabelled), features, prior, decay)
    w = np.zeros(features + 1)
    w[-1] = np.log(prior / (1 - prior))
    w = risk.least(w, 1.0, tolerance)
    low, high = 0.0, 1.0  # the second part at its least point falls as s grows
    if risk.parts(w)[1] < 0:
        while high - low > 1e-6:
            s = (low + high) / 2
            w = risk.least(w, s, tolerance)
            second = risk.parts(w)[1]
            if abs(second) <= 1e-7:
                break
            low, high = (s, high) if second > 0 else (low, s)
    return w[:-1], float(w[-1])


class Model:
    """Weights by hashed piece; scores texts."""

    def __init__(self, features: list[int], weights: list[float], bias: float | None):
        self.features, self.weights, self.bias = features, weights, bias

    def scorer(self):
        """texts -> scores, for one worker."""
        if self.bias is None:
            return lambda texts: [0.0] * len(texts)
        extract, weights = Extractor({f: k for k, f in enumerate(self.features)}), np.array(self.weights)

        def scores(texts: list[str | None]) -> list[float]:
            g = np.array([weights[extract(t)].sum() if t else 0.0 for t in texts]) + self.bias
            return (1 / (1 + np.exp(-g))).tolist()

        return scores


def _sample(docs: DataFrame, labels: DataFrame, positives: int, unlabelled: int) -> tuple[DataFrame, float]:
    """(is_positive, text) of the bounded fit sample, and the class prior."""
    told = labels.where(learns_from("doc_id") & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ones, known = told.agg(F.count(F.when(F.col("toxic") == 1, 1)), F.count(F.lit(1))).first()
    if not ones:
        return docs.limit(0).select(F.lit(1).alias("is_positive"), "text"), 0.0
    order = F.xxhash64("doc_id", F.lit(SEED))
    chosen = told.where((F.col("toxic") == 1) & drawn(min(1.0, 2 * positives / ones), SEED)).orderBy(order).limit(positives).select("doc_id")
    learned = docs.select("doc_id", "text").where(learns_from("doc_id"))
    p = learned.join(F.broadcast(chosen), "doc_id").select(F.lit(1).alias("is_positive"), "text")  # at most ``positives`` ids
    total = max(1, learned.count())
    u = learned.where(drawn(min(1.0, unlabelled / total), SEED + 1)).select(F.lit(0).alias("is_positive"), "text")
    return p.union(u), min(0.95, max(0.001, ones / known))


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED, features: int = FEATURES) -> Model:
    sample, prior = _sample(docs, labels, positives, unlabelled)
    if not prior:
        return Model([], [], None)

    def extract(batches: Iterator[Columns]) -> Iterator[Columns]:
        own = Extractor()
        for b in batches:
            yield {"is_positive": b["is_positive"], "f": [own(t) for t in b["text"]]}

    rows = frozen(map_columns(sample, extract, {"is_positive": "int", "f": "array<int>"}))
    sizes = {r["is_positive"]: r["count"] for r in rows.groupBy("is_positive").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return Model([], [], None)
    n_p, n_u = sizes[1], sizes[0]
    rate_p, rate_u = F.col("in_p") / n_p, F.col("in_u") / n_u
    pooled = (F.col("in_p") + F.col("in_u")) / (n_p + n_u)
    z = F.abs(rate_p - rate_u) / F.sqrt(pooled * (1 - pooled) * (1 / n_p + 1 / n_u) + 1e-12)
    by_piece = rows.select("is_positive", F.explode("f").alias("f")).groupBy("f").agg(
        F.sum("is_positive").alias("in_p"), F.sum(1 - F.col("is_positive")).alias("in_u")
    )
    best = [r["f"] for r in by_piece.where((F.col("in_p") + F.col("in_u") >= 5) & (z >= LEAST_Z)).orderBy(F.desc(z), "f").limit(features).select("f").collect()]
    number = {f: k for k, f in enumerate(best)}
    kept = F.array_intersect("f", F.lit(best)) if best else F.array().cast("array<int>")
    sample: dict[int, Rows] = {0: [], 1: []}
    for r in rows.select("is_positive", kept.alias("f")).toLocalIterator():  # at most positives + ~unlabelled rows of ``features`` numbers
        sample[r["is_positive"]].append(sorted(number[f] for f in r["f"]))
    w, bias = fit_nnpu(sample[1], sample[0], len(best), prior)
    return Model(best, w.tolist(), bias)


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of each row."""

    def work(batches: Iterator[Columns]) -> Iterator[Columns]:
        scores = model.scorer()
        for b in batches:
            yield {"doc_id": b["doc_id"], "score": scores(b["text"])}

    docs = docs.select("doc_id", "text")
    return map_columns(docs, work, {"doc_id": kind_of(docs, "doc_id"), "score": "double"})


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row."""
    scored = score_toxicity(docs, train(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(~learns_from("doc_id"), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, unchanged."""
    model = train(docs, labels)

    def work(batches):
        scores = model.scorer()
        for batch in batches:
            keep = [s < threshold for s in scores(batch.column("text").to_pylist())]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return batch_rows(docs).mapInArrow(lean(work), docs.schema)
