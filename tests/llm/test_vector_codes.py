import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from daybook.llm import vector_codes as vc


def brute(rows, parts=16, entries=64, rounds=2):
    """The contract in Python integers."""
    kept = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    w = len(kept[0][2]) // parts
    part = lambda v, p: v[p * w : p * w + w]
    books = [[part(r[2], p) for r in kept[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            mine = defaultdict(list)
            for r in kept:
                mine[near(part(r[2], p), books[p])[1]].append(part(r[2], p))
            for k, xs in mine.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs)]
    out, by_label = [], Counter()
    for i, lab, v in kept:
        found = [near(part(v, p), books[p]) for p in range(parts)]
        out.append((i, lab, bytes(k for _, k in found).hex(), sum(d for d, _ in found)))
        by_label[lab] += out[-1][3]
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return Counter((i, code, e, by_label[lab], sha) for i, lab, code, e in out)


def vectors(spark, rows, kind="float", partitions=4):
    return spark.createDataFrame(rows, f"vec_id long, label string, embedding array<{kind}>, code string").repartition(partitions)


def made(n, dims, seed, scale=1.0):
    rng = random.Random(seed)
    return [(k, rng.choice(["a", "b", None, "a"]), [float(np.float32(rng.gauss(0, scale))) for _ in range(dims)]) for k in range(n)]


def rows_of(df):
    return Counter(map(tuple, df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()))


@pytest.mark.parametrize("kind, scale, n", [("float", 1.0, 400), ("double", 3e7, 150), ("double", 1e12, 90), ("float", 0.004, 300)])
def test_against_brute_force(spark, kind, scale, n):
    rows = made(n, 32, n, scale)
    got = rows_of(vc.code_report(vectors(spark, [(*r, "clash") for r in rows], kind)))
    want = brute(rows)
    assert got == Counter({(i, c, e if e < 2**63 else None, t if t < 2**63 else None, s): k for (i, c, e, t, s), k in want.items()})


def test_nulls_ties_and_repeats(spark):
    rows = made(120, 16, 5) + [(3, "a", [0.5] * 16)] * 40  # ties of id, and rows that repeat
    rows += [(900, "b", None), (901, "a", [1.0] * 15 + [None]), (902, "a", [float("nan")] + [0.0] * 15), (903, None, [float("-inf")] * 16), (None, None, [0.25] * 16)]
    rows += [(904 + k, "a", [0.5] * 8 + [-0.5] * 8) for k in range(30)]
    assert rows_of(vc.code_report(vectors(spark, [(*r, "x") for r in rows]))) == brute(rows)


def test_few_rows_and_none(spark):
    rows = made(5, 16, 1)
    got = rows_of(vc.code_report(vectors(spark, [(*r, "x") for r in rows])))
    assert got == brute(rows) and all(e == 0 for _, _, e, _, _ in got)
    assert vc.code_report(vectors(spark, [])).count() == 0
    assert vc.code_report(vectors(spark, [(1, "a", None, "x")])).count() == 0


def test_other_lengths_and_huge_numbers_stay_without_code(spark):
    rows = made(70, 16, 2)
    odd = [(1000, "a", [1.0] * 17), (1001, "a", []), (1002, "b", [1e300] + [0.0] * 15)]
    got = vc.code_report(vectors(spark, [(*r, "x") for r in rows + odd], "double")).collect()
    assert {r.vec_id for r in got if r.code is None} == {1000, 1001, 1002} and all(r.error is None for r in got if r.code is None)
    assert rows_of(vc.code_report(vectors(spark, [(*r, "x") for r in rows], "double"))) <= Counter(tuple(r) for r in got)


@pytest.mark.parametrize("bits", [5, 22, 23, 24, 40, 61])
def test_limb_products_are_exact(bits):
    rng = random.Random(bits)
    x, c = ([[rng.randrange(-(1 << bits), 1 << bits) for _ in range(7)] for _ in range(n)] for n in (9, 5))
    got = vc.exact_products(np.array(x, np.int64), np.array(c, np.int64))
    assert got.tolist() == [[sum(a * b for a, b in zip(p, q)) for q in c] for p in x]
    back = vc.limbs(np.array(x, np.int64), 22)
    assert (sum(b.astype(np.int64) << 22 * k for k, b in enumerate(back)) == np.array(x)).all()


def test_decode_gives_the_entries(spark):
    rows = [(*r, "x") for r in made(200, 16, 8)]
    coded, books = vc.encode(vectors(spark, rows))
    got = {r.vec_id: r for r in coded.collect()}
    back = vc.decode([got[r[0]].code for r in rows], books)
    for r, v in zip(rows, back):
        whole = np.floor(256 * np.array(r[2])).astype(np.int64)
        assert got[r[0]].error == int(((whole - v) ** 2).sum())


def test_uneven_parts(spark):
    rows = [(*r, "x") for r in made(80, 19, 3)]
    coded, books = vc.encode(vectors(spark, rows))
    assert coded.where("code is null").count() == 0 and books.shape == (64, 19)
