import hashlib
import random

import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from daybook.llm.sentencepiece_codec import MODEL, SPACE, DoubleArray, codec, coded, decode_texts, encode_texts
from daybook.llm.tokens import tokenizer_path


def unigram_library():
    """The same pieces and scores, read by the library as a unigram model."""
    model = pb.ModelProto()
    with open(tokenizer_path(None, MODEL), "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def best_by_hand(text: str, c) -> float:
    """The greatest score sum of any cut, over dictionary look-ups."""
    if not text:
        return 0.0
    s = SPACE + text.replace(" ", SPACE)
    known = {p: i for i, p in enumerate(c.pieces) if i not in c.byte_ids.values() and i > 2}
    best = [0.0] + [float("-inf")] * len(s)
    for i in range(len(s)):
        if s[i] not in known:
            best[i + 1] = max(best[i + 1], best[i] + c.unknown_score)
        for j in range(i + 1, min(len(s), i + c.longest) + 1):
            if s[i:j] in known:
                best[j] = max(best[j], best[i] + c.score[known[s[i:j]]])
    return best[-1]


def score_of(ids, c) -> float:
    """The score sum of ids; a run of byte pieces counts as its characters."""
    total, run = 0.0, b""
    for i in [*ids, None]:
        if i is not None and i in c.byte_ids.values():
            run += c.surface[i]
            continue
        total += len(run.decode()) * c.unknown_score
        run = b""
        total += 0.0 if i is None else float(c.score[i])
    return total


def texts():
    rng = random.Random(1)
    parts = [" ", "  ", "the", "tion", "\n", "\t", "é", "日本", "☃", "😀", "ing", "a", "'s", "123", ",", ".", "\x00", "Ω"]
    return ["", " ", "a", " a  b ", "x" * 200, *("".join(rng.choice(parts) for _ in range(n)) for n in (3, 10, 30, 30, 60, 60, 120))]


def test_score_is_the_best_and_the_librarys(spark, sf_small):
    c, library = codec(), unigram_library()
    some = texts() + [r.text[:400] for r in spark.read.parquet(f"{sf_small}/documents.parquet").limit(60).collect()]
    for text, ids in zip(some, c.encode(some)):
        assert score_of(ids, c) == best_by_hand(text, c)
        if text:
            best = library.nbest_encode(text, nbest_size=2)[0]
            assert score_of(ids, c) >= score_of(best, c)


def test_round_trip_and_library_decoding(spark, sf_small):
    c = codec()
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(None, MODEL))
    some = texts() + [r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    for text, ids in zip(some, c.encode(some)):
        assert c.decode(ids) == text
        assert library.decode(ids) == text
        assert c.decode(library.encode(text)) == text
    assert c.decode(c.encode(["a▁b"])[0]) == "a b"  # the one exception


def test_double_array_holds_its_keys():
    rng = random.Random(2)
    keys = sorted({tuple(rng.randint(1, 6) for _ in range(rng.randint(1, 5))) for _ in range(300)})
    trie = DoubleArray([(k, v) for v, k in enumerate(keys)], 7)

    def find(key):
        state = 0
        for c in key:
            to = trie.base[state] + c
            if trie.check[to] != state:
                return -1
            state = to
        return trie.value[state]

    assert [find(k) for k in keys] == list(range(len(keys)))
    for _ in range(500):
        key = tuple(rng.randint(1, 6) for _ in range(rng.randint(1, 6)))
        assert find(key) == (keys.index(key) if key in keys else -1)


def test_edges(edge_docs, no_docs, edge_rows):
    got = coded(edge_docs).collect()
    assert len(got) == len(edge_rows)
    want = {r[0]: None if r[1] is None else hashlib.sha256(r[1].replace(SPACE, " ").encode()).hexdigest() for r in edge_rows if r[0] is not None}
    assert {r.doc_id: r.decoded_sha256 for r in got if r.doc_id is not None} == want
    assert all(r.n_tokens == len(r.ids or []) for r in got)
    back = decode_texts(encode_texts(edge_docs)).collect()
    assert sorted(str(r.text) for r in back) == sorted(str(r[1]).replace(SPACE, " ") for r in edge_rows)
    assert coded(no_docs).count() == 0
