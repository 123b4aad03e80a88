import random
from collections import Counter

import numpy as np

from daybook.llm.prob_minhash import WordHashes, drop_near_dups, links_in_bucket, near_dup_classes, prob_minhash, probability_jaccard, shingle_tables


def shingles(text, n=5):
    words = "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()
    return Counter(tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))) if words else Counter()


def similarity(a, b):
    """Probability Jaccard, straight from its definition."""
    return sum(1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in a.keys() | b.keys()) for d in a.keys() & b.keys())


def by_hand(rows, threshold=0.8):
    """doc_id of each class's least member, for each row."""
    own = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if own[a] and own[b] and find(a) != find(b) and similarity(own[a], own[b]) >= threshold:
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [least.get(find(k)) for k in range(len(rows))]


def changed(rng, words, share):
    return " ".join(f"new{rng.randrange(10**6)}" if rng.random() < share else w for w in words)


def test_shingle_tables_and_jaccard():
    texts = ["a b c d e f a b c d e f", "a b c d e f", "one two", "", "a b c d e f a b c d e x"]
    h, n, owner = shingle_tables(texts, WordHashes())
    for k, t in enumerate(texts):
        assert sorted(n[owner == k]) == sorted(shingles(t).values())
    for a in (0, 1, 2, 4):
        for b in (0, 1, 2, 4):
            got = probability_jaccard(h[owner == a], n[owner == a], h[owner == b], n[owner == b])
            assert abs(got - similarity(shingles(texts[a]), shingles(texts[b]))) < 1e-12


def test_jaccard_on_random_weights():
    rng = random.Random(1)
    for _ in range(100):
        a = Counter({k: rng.randint(1, 5) for k in rng.sample(range(20), 8)})
        b = Counter({k: rng.randint(1, 5) for k in rng.sample(range(20), 11)})
        arrays = [np.array(x) for t in (a, b) for x in (sorted(t), [t[k] for k in sorted(t)])]
        assert abs(probability_jaccard(*arrays) - similarity(a, b)) < 1e-12


def test_registers_agree_with_probability_jaccard():
    rng = np.random.default_rng(2)
    size = 4000
    for shared in (5, 30, 60):
        ids = rng.integers(1, 2**63, 100).astype(np.uint64)
        a = {int(i): float(rng.integers(1, 4)) for i in ids[: 50 + shared // 2]}
        b = {int(i): float(rng.integers(1, 4)) for i in ids[50 - shared // 2 :]}
        signature = []
        for t in (a, b):
            h = np.array(sorted(t), dtype=np.uint64)
            signature.append(prob_minhash(h, np.array([t[int(i)] for i in h]), np.zeros(len(h), dtype=np.int64), 1, size)[0])
        agree = (signature[0] == signature[1]).mean()
        want = similarity(Counter(a), Counter(b))
        assert abs(agree - want) < 5 * (want * (1 - want) / size) ** 0.5 + 0.005


def test_links_in_bucket_equal_all_pairs():
    rng = random.Random(3)
    for trial in range(40):
        n, base, tables = rng.randint(2, 25), range(20), []
        for _ in range(n):
            own = {x: rng.choice([1, 1, 1, 2, 3]) if trial % 2 else 1 for x in base if rng.random() < 0.9}
            own |= {100 + rng.randrange(30): 1 for _ in range(rng.randrange(4))}
            keys = sorted(own) or [1]
            tables.append((np.array(keys, dtype=np.uint64), np.array([own.get(k, 1) for k in keys], dtype=np.uint32)))
        root = np.array([rng.randrange(n) for _ in range(n)])
        first = np.array([trial % 3 > 0 or rng.random() < 0.5 for _ in range(n)])
        got = {(int(i), int(j)) for a, b in links_in_bucket(tables, first, root, 0.8) for i, j in zip(a, b)}
        pairs = [(i, j) for i in range(n) for j in range(n) if (i < j if first.all() else first[i] and not first[j])]
        assert got == {(i, j) for i, j in pairs if root[i] != root[j] and probability_jaccard(*tables[i], *tables[j]) >= 0.8}


def test_tiny_tiles_find_the_same_links(spark):
    """Buckets cut into many tiles, and no delegates at all."""
    from daybook.llm import prob_minhash as pm

    rows = [(k, (t or "").lower().split()) for k, (_, t) in enumerate(corpus())]
    rows = [(k, " ".join(w)) for k, w in rows if w]
    h, n, owner = shingle_tables([t for _, t in rows], WordHashes())
    keys = pm.band_keys(prob_minhash(h, n.astype(float), owner, len(rows), 144), 24, 6)
    tables = spark.createDataFrame(
        [(k, bytearray(h[owner == k].tobytes()), bytearray(n[owner == k].astype("<u4").tobytes())) for k in range(len(rows))],
        "node long, shingles binary, counts binary",
    )
    members = spark.createDataFrame([(int(x), k) for k in range(len(rows)) for x in keys[k]], "key long, node long")
    shared = members.groupBy("key").count().where("count > 1").select("key")
    members = members.join(shared, "key")
    none = spark.createDataFrame([], "node long, root long")
    want = {(r.node, r.root) for r in pm.near_dup_links(members, tables, 0.8).collect()}
    for tile_rows in (2048, 8):
        links = pm.bucket_links(members, none, tables, 0.8, tile_rows)
        assert {(r.node, r.root) for r in pm.connected_components(links).collect()} == want


def corpus():
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(400)]
    rows, doc_id = [], 0
    for group in range(12):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([8, 60, 250]))]
        for share in [0.0, 0.0, 0.002, 0.005, 0.01, 0.02, 0.04][: rng.randint(1, 7)]:
            rows.append((doc_id := doc_id + rng.randint(1, 9), changed(rng, words, share)))
    hot = [rng.choice(vocabulary) for _ in range(300)]
    for k in range(80):  # one large group of near copies
        rows.append((5000 + k, changed(rng, hot, rng.choice([0.0, 0.003, 0.01]))))
    shared = [rng.choice(vocabulary) for _ in range(60)]
    for k in range(30):  # texts that share a passage only
        rows.append((6000 + k, " ".join(shared + [rng.choice(vocabulary) for _ in range(120)])))
    rows += [(1, None), (2, ""), (3, " ... "), (7000, "Short text"), (7001, "short, text!"), (None, "short text"), (None, "alone, with no id"), (7002, "one")]
    rows += [(7003, "again and " * 300), (7004, "again and " * 310), (7004, "again and " * 310)]
    return rows


def test_classes_equal_brute_force(spark):
    rows = corpus()
    frame = spark.createDataFrame([(i, t, "x", "x") for i, t in rows], "doc_id long, text string, class_id string, key string").repartition(5)
    got = Counter((r.doc_id, r.class_id) for r in near_dup_classes(frame).collect())
    assert got == Counter(zip((i for i, _ in rows), by_hand(rows)))
    kept = drop_near_dups(frame)
    assert kept.columns == frame.columns
    want = [i for (i, _), c in zip(rows, by_hand(rows)) if i is not None and i == c]
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(want)


def test_edges(edge_docs, no_docs, edge_rows):
    assert near_dup_classes(edge_docs).count() == len(edge_rows)
    assert near_dup_classes(no_docs).count() == 0
    assert drop_near_dups(no_docs).count() == 0


def test_repeated_and_null_ids_take_no_other_text_along(spark):
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(400)]
    text = lambda k: " ".join(rng.choice(words) for _ in range(60))
    first, clean, other, lone = (text(k) for k in range(4))
    near, nearer = f"{first} extra", f"more {first}"
    rows = [
        (1, first),
        (5, near),  # a near copy of 1 goes
        (5, clean),  # another text under its id stays
        (None, nearer),  # a near copy without id goes
        (None, lone),  # a text of its own without id stays
        (8, other),
        (8, f"{other} extra"),  # two near copies under one id: one stays
        (9, text(5)),
        (None, ""),
        (None, None),
    ]
    rows += [rows[7]] * 2  # a row that repeats: one stays
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, digest string, _nd_id string").repartition(3)
    kept = drop_near_dups(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert len(got) == 7 and [t for i, t in got if i == 8][0] in (other, f"{other} extra")
    assert sorted((i, t) for i, t in got if i not in (8, None)) == sorted([(1, first), (5, clean), (9, rows[7][1])])
    assert sorted(str(t) for i, t in got if i is None) == sorted([lone, "", "None"])
    classes = near_dup_classes(docs)
    assert classes.count() == len(rows) and classes.where("kept").count() == 9


def test_long_texts_make_more_tiles(spark, monkeypatch):
    """Tiles of few shingles find the links that one tile finds."""
    import daybook.llm.prob_minhash as pm

    rng = random.Random(13)
    words = ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(900)]
    base = [rng.choice(words) for _ in range(200)]
    rows = []
    for k in range(60):
        own = list(base)
        for at in rng.sample(range(200), k % 9):
            own[at] = rng.choice(words)
        rows.append((k, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(near_dup_classes(docs).collect())
    inner, tiles = pm.bucket_links, []

    def small(members, roots, tables, threshold):
        tiles.append(1)
        return inner(members, roots, tables, threshold, tile_shingles=500)

    monkeypatch.setattr(pm, "bucket_links", small)
    assert sorted(near_dup_classes(docs).collect()) == want and tiles
