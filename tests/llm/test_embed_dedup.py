from collections import defaultdict

import numpy as np
from pyspark.sql import types as T

from daybook.llm.embed_dedup import embedding_near_dups, quantise, upper_bounds

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        T.StructField("n_links", T.StringType()),
        T.StructField("node", T.StringType()),
    ]
)


def by_hand(rows, threshold=0.98):
    ok = {}
    for k, (_, e, label, *_) in enumerate(rows):
        if label is not None and e is not None and all(x is not None and np.isfinite(x) for x in e) and any(e):
            ok[k] = np.array(e, dtype=np.float32).astype(np.float64)
    links, root = defaultdict(int), list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in ok:
        for b in ok:
            if a < b and rows[a][2] == rows[b][2] and len(ok[a]) == len(ok[b]):
                if ok[a] @ ok[b] / (np.linalg.norm(ok[a]) * np.linalg.norm(ok[b])) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    root[find(a)] = find(b)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[find(k)] = min(least.get(find(k), r[0]), r[0])
    return sorted(((r[0], links[k], least.get(find(k)), r[0] == least.get(find(k))) for k, r in enumerate(rows)), key=str)


def rows_for_test():
    rng = np.random.default_rng(4)
    rows = []
    for k in range(40):
        base = rng.normal(size=16)
        for _ in range(rng.integers(1, 7)):
            v = base + rng.normal(size=16) * rng.choice([0.02, 0.15, 0.2, 0.25])
            rows.append((int(len(rows) * 7 % 211), v.astype(np.float32).tolist(), int(k % 3), "x", "x"))
    hot = rng.normal(size=16).astype(np.float32).tolist()
    rows += [(1000 + k, hot, 1, "x", "x") for k in range(60)]  # copies
    rows += [(2000 + k, (np.array(hot) + rng.normal(size=16) * 0.1).astype(np.float32).tolist(), 1, "x", "x") for k in range(60)]
    rows += [
        (900, None, 1, "x", "x"),
        (901, [], 1, "x", "x"),
        (902, [0.0] * 16, 1, "x", "x"),
        (903, [float("nan")] * 16, 1, "x", "x"),
        (904, [1.0, None] * 8, 1, "x", "x"),
        (905, [float("inf")] + [1.0] * 15, 1, "x", "x"),
        (906, hot, None, "x", "x"),
        (907, hot, None, "x", "x"),
        (908, hot[:8], 1, "x", "x"),
        (None, hot, 1, "x", "x"),
        (None, [1.0] * 4, 2, "x", "x"),
        (909, [1e-30] * 16, 2, "x", "x"),
        (910, [1e30] * 16, 2, "x", "x"),
        (1000, hot, 1, "x", "x"),  # a repeated row
    ]
    return rows


def test_links_and_components_equal_brute_force(spark):
    rows = rows_for_test()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for tile_rows in (2048, 16):
        got = embedding_near_dups(frame, tile_rows=tile_rows).collect()
        assert sorted((tuple(r) for r in got), key=str) == by_hand(rows)


def test_bounds_hold_for_each_pair():
    rng = np.random.default_rng(5)
    for dims in (3, 64, 1500):
        x = rng.normal(size=(60, dims)) * rng.choice([1e-3, 1, 1e4], size=(60, 1))
        x[:, 0] *= rng.choice([1, 100], size=60)  # coarse codes
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        bound = upper_bounds(quantise(x), quantise(x))
        assert (bound >= unit @ unit.T).all()
        assert (bound - unit @ unit.T).max() < 0.35


def test_empty_table(spark):
    assert embedding_near_dups(spark.createDataFrame([], SCHEMA)).count() == 0
