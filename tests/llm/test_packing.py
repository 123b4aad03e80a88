import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

import pytest

from daybook.llm.packing import CapacityTree, best_fit_packing, best_fit_steps, cut
from daybook.llm.tokens import byte_bpe, encoder, tokenizer_path


def library():
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return t


def test_ids_equal_the_library(spark, sf_small, edge_rows):
    texts = [r[1] for r in edge_rows if r[1]] + [r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").limit(150).collect()]
    t = library()
    for text in texts:
        assert byte_bpe().encode_ordinary(text) == t.encode(text, add_special_tokens=False).ids


def test_tree_finds_the_tightest_room():
    rng = random.Random(1)
    tree, plain = CapacityTree(50), []
    for k in range(3000):
        if rng.random() < 0.5:
            room = rng.randint(1, 50)
            tree.put(room, k, 1)
            plain.append((room, k))
        else:
            need = rng.randint(1, 50)
            fits = [r for r, _ in plain if r >= need]
            got = tree.take(need)
            assert (got is None) == (not fits)
            if got:
                assert got[0] == min(fits) and got[:2] in plain and got[2] == 1
                plain.remove(got[:2])


@pytest.mark.parametrize("seed, most, n", [(2, 100, 500), (3, 100, 3000), (4, 16, 400), (5, 1, 7), (6, 64, 1)])
def test_best_fit_is_best_fit_decreasing(seed, most, n):
    rng = random.Random(seed)
    lengths = sorted((min(most, 1 + int(rng.expovariate(4 / most))) for _ in range(n)), reverse=True)
    histogram = {x: lengths.count(x) for x in set(lengths)}
    steps = best_fit_steps(histogram, most)
    bins, numbers = defaultdict(list), defaultdict(list)
    for length, first, pieces, bin_no, offset in steps:
        numbers[length] += range(first, first + pieces)
        for k in range(pieces):
            bins[bin_no + k].append((offset, length))
    assert {x: sorted(own) for x, own in numbers.items()} == {x: list(range(c)) for x, c in histogram.items()}
    left = []
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= most
        left.append(most - at)
    rooms = []
    for x in lengths:  # brute force, one piece at a time
        fits = [k for k, r in enumerate(rooms) if r >= x]
        k = min(fits, key=lambda k: rooms[k]) if fits else len(rooms)
        if not fits:
            rooms.append(most)
        rooms[k] -= x
    assert sorted(left) == sorted(rooms) and sorted(bins) == list(range(len(rooms)))


def test_a_corpus_of_any_size_packs_in_few_steps():
    rng = random.Random(9)
    histogram = {length: int(1e9 / length**1.2 * rng.uniform(0.5, 1.5)) + 1 for length in range(1, 2049)}
    steps = best_fit_steps(histogram, 2048)
    tokens = sum(length * n for length, n in histogram.items())
    used = max(bin_no + n for _, _, n, bin_no, _ in steps)
    assert sum(n for _, _, n, _, _ in steps) == sum(histogram.values()) and len(steps) < 100_000
    assert used <= tokens / 2048 * 1.0001 + 1


def test_cut():
    assert cut(5, 4) == [(0, 1), (1, 4)] and cut(8, 4) == [(0, 4), (4, 4)] and cut(1, 4) == [(0, 1)]


def check_packed(rows, texts, most=2048):
    t, own, bins = library(), defaultdict(list), defaultdict(list)
    for r in rows:
        own[r.doc_id].append(r)
        bins[r.sequence_id].append(r)
    for pieces in bins.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= most
    for doc_id, text in texts.items():
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        pieces = sorted(own[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert [(r.start, r.length) for r in pieces] == cut(len(ids), most)
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in pieces)
    return len(bins), sum(r.length for r in rows)


def test_edges(edge_docs, edge_rows):
    docs = edge_docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = best_fit_packing(docs).collect()
    check_packed(rows, {r[0]: r[1] for r in edge_rows if r[0] is not None})
    assert best_fit_packing(edge_docs).groupBy().sum("length").first()[0] > sum(r.length for r in rows)  # null ids and repeats too


def test_documents_pack_tightly(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    bins, tokens = check_packed(best_fit_packing(docs).collect(), {r.doc_id: r.text for r in docs.collect()})
    assert bins <= tokens / 2048 * 1.02 + 2


def test_hot_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "one two three")] * 3000 + [(k, "w " * k) for k in range(50)], "doc_id long, text string").repartition(6)
    rows = best_fit_packing(docs).collect()
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append(r)
    for own in bins.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))] and sum(r.length for r in own) <= 2048
    assert len(rows) == 3050 and sorted(bins) == list(range(len(bins)))


@pytest.mark.parametrize("added", [False, True])
def test_long_runs_of_white_space(added):
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = not added
    encode, n = encoder(None, added), 1_000_000
    runs = [" " * n, "\t" * n + "x", " " * n + "x", "a" + "\u3000" * 400_000 + "b", "\xa0" * 400_000, "\r\n" * 9000 + "<|endoftext|>" + " " * 9000]
    runs += [" " * k + "y" + "\n" * 4097 + " z" for k in (4095, 4096, 4097)]
    for text in runs:
        assert encode(text) == t.encode(text, add_special_tokens=False).ids


def test_empty_table(no_docs):
    assert best_fit_packing(no_docs).count() == 0


def test_queries_have_the_ids_of_the_library_at_its_defaults(spark, tmp_path):
    import corpus_pipeline
    from daybook.llm.queries import op7_best_fit_packing

    texts = ["a<|endoftext|>b", "<|endoftext|>", "x <|endoftext|> \n<|endoftext|><|endoftext|>y", "<|endoftext>", "<<|endoftext|>|>", "日本<|endoftext|>語 ", "plain  text", "one <|endoftext|>" * 900]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    t = Tokenizer.from_file(tokenizer_path())
    assert t.encode(texts[0], add_special_tokens=False).ids == [64, 50256, 65]
    ids = [np.array([*t.encode(text, add_special_tokens=False).ids, 0], dtype="<u4") for text in texts]
    want = sorted((k, start, n, zlib.crc32(own[start : start + n].tobytes())) for k, own in enumerate(ids) for start, n in cut(len(own), 2048))
    for packed in (op7_best_fit_packing(spark, str(tmp_path)), corpus_pipeline.packing(spark, docs, str(tmp_path))):
        assert sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in packed.collect()) == want
