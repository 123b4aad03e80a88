import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from daybook.llm import divergence as dv

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, min_docs=30):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for text, lang, source in docs]
    spread, out = defaultdict(Counter), []
    for lang, _, terms in docs:
        spread[lang].update(set(terms))
    for lang, in_docs in [(x, spread[x]) for x in {d[0] for d in docs}]:
        kept = sorted((t for t, n in in_docs.items() if n >= min_docs), key=str.encode)
        counts = defaultdict(Counter)
        for _, source, terms in (d for d in docs if d[0] == lang):
            counts[source].update(t for t in terms if t in set(kept))
        counts = {s: counts[s] for s in {d[1] for d in docs if d[0] == lang}}
        total = sum(counts.values(), Counter())

        def share(c):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p, q = {s: share(c) for s, c in counts.items()}, share(total)
        for s in counts:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in counts if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, 50)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (item, v) in enumerate(found[:most])]
    return Counter(out)


def made(spark, docs, partitions=3):
    return spark.createDataFrame([(*d, "x", "y") for d in docs], "text string, lang string, source string, item string, term string").repartition(partitions)


def words(k):
    pool = "alpha Beta GAMMA delta épsilon zeta日 eta_theta iota-kappa ÀB x9y Straße".split()
    return " ".join(pool[(k * k + j * (k % 5 + 1)) % len(pool)] for j in range(k % 17))


@pytest.mark.parametrize("cells, tile", [(dv.CELLS, dv.TILE), (20, 2)])
def test_against_brute_force(spark, cells, tile):
    docs = [(words(k), ("en", "de", None)[k % 3], ("a", "b", "", None, "ü", "long name")[k * k % 6]) for k in range(400)]
    docs += [(None, "en", "empty source"), ("rare words only here", "fr", "a"), ("other", "fr", "b"), ("", "fr", "c"), ("x", "solo", "s")]
    got = Counter(map(tuple, dv.divergence(made(spark, docs), cells=cells, tile=tile).collect()))
    assert got == brute(docs)
    assert any(r[0] == "fr" and r[2] == "pair" and r[4] == 0 for r in got)


def test_more_than_fifty_terms_and_ties(spark):
    def name(k):
        return "".join(chr(97 + int(d)) for d in f"{k:03d}")

    docs = [(" ".join(name(k) for k in range(120)), "en", "a")] * 30 + [(" ".join(name(k) for k in range(0, 120, 2)), "en", "b")] * 30
    got = Counter(map(tuple, dv.divergence(made(spark, docs)).collect()))
    assert got == brute(docs) and max(r[5] for r in got if r[2] == "term") == 50


def test_edges(edge_docs, edge_rows, no_docs):
    got = Counter(map(tuple, dv.divergence(edge_docs, min_docs=2).collect()))
    assert got == brute([(r[1], r[2], r[3]) for r in edge_rows], 2)
    assert dv.divergence(no_docs).count() == 0


def test_texts_are_cut_between_terms():
    text = ("Añb c9d " * 500 + "x" * 700 + " yz").encode()
    for piece in (1, 7, 64, 10_000):
        got = [t for part in dv.term_lists(text, piece) for t in part]
        assert got == [t.translate(LOWER).encode() for t in TERM.findall(text.decode())]


def test_every_byte_is_sorted_right():
    for c in range(128):
        assert (dv.TO_TERMS[c] != 32) == bool(TERM.fullmatch(chr(c)))
    assert all(dv.TO_TERMS[c] == c for c in range(128, 256))


def test_shares_and_runs():
    big = np.array([0, 1, 10**12, 9 * 10**12])
    assert dv.shares(big, 10**13, 10**6).tolist() == [1 + 10**9 * (int(c) + 5) // (10**13 + 5 * 10**6) for c in big]
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 3, 200), rng.integers(0, 2, 200)
    order = dv.clustered([a, b])
    assert len(dv.runs(b[order])[0]) == 2 and len(dv.runs(a[order])[0]) <= 6  # the column with fewer kinds first
    assert dv.runs_apart(dv.runs(a[order]), dv.runs(b[order])) == int(np.abs(a - b).sum())


def test_counts_leave_a_task_when_it_holds_many(monkeypatch):
    monkeypatch.setattr(dv, "HELD_TERMS", 3)
    held = dv._Held()
    held.add(("en", "a"), b"one two two three four")
    assert held.full()
    out = {r["term"]: (r["n"], r["docs"]) for b in held.out() for r in b.to_pylist()}
    assert out == {b"one": (1, 1), b"two": (2, 1), b"three": (1, 1), b"four": (1, 1)} and not held.full()
