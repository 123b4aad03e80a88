import zlib

import numpy as np

from daybook.llm.language_id import BLOCK, CrossParser, identify_language, keep_known_language, language_samples, pass_parser, sample_passes, sample_rows

SAMPLES = (("ab", "abab abba baab abab"), ("cd", "cdcd dccd ddcc cdcd"))


def phrases_by_hand(text: str, sample: str) -> int:
    """Longest-match parsing by substring search, block by block."""
    count = 0
    for at in range(0, len(text), BLOCK):
        block = text[at : at + BLOCK]
        i = 0
        while i < len(block):
            n = 1
            while i + n < len(block) and block[i : i + n + 1] in sample:
                n += 1
            count += 1
            i += n
    return count


def test_phrases_equal_substring_search():
    rng = np.random.default_rng(1)
    samples = tuple((f"l{k}", "".join(rng.choice(list("abcd "), 300)).strip()) for k in range(3))
    parser = CrossParser.of(samples)
    from daybook.llm.language_id import plain

    texts = ["", "a", "zzz", "aézb", *("".join(rng.choice(list("abcde "), n)) for n in (5, 100, BLOCK, BLOCK + 1, 3 * BLOCK + 7))]
    got = parser.phrases(texts)
    for t, row in zip(texts, got):
        assert row.tolist() == [phrases_by_hand(plain(t), plain(s)) for _, s in samples]


def test_predictions():
    parser = CrossParser.of(SAMPLES)
    lang, score = parser.predict(["abab", "dcdc", None, "", "12 34", "☃"])
    assert lang == ["ab", "cd", "und", "und", "und", "und"]
    assert score[2:] == [0.0] * 4 and all(0.5 < s <= 1 for s in score[:2])
    assert CrossParser.of(()).predict(["abc"]) == (["und"], [0.0])


def test_held_out_accuracy(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small.replace('0.001', '0.01')}/documents.parquet")
    got = {r.doc_id: r for r in identify_language(docs).collect()}
    rows = docs.select("doc_id", "lang").collect()
    assert len(got) == len(rows)
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if got[r.doc_id].held_out]
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.98 * len(held)


def test_held_out_labels_are_not_read(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    spoiled = docs.selectExpr("doc_id", "text", "if(crc32(cast(doc_id AS string)) % 4 = 2, 'wrong', lang) AS lang")
    assert language_samples(spoiled) == language_samples(docs)


def test_edges(edge_docs, no_docs, edge_rows):
    rows = identify_language(edge_docs).collect()
    assert len(rows) == len(edge_rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in rows if r.doc_id in (9, 4, 3, 8, 12)} == {"und"}
    assert not any(r.held_out for r in rows if r.doc_id is None)
    kept = keep_known_language(edge_docs)
    assert kept.columns == edge_docs.columns and kept.count() == len(edge_rows) - 5
    assert identify_language(no_docs).count() == 0 and keep_known_language(no_docs).count() == 0


def languages_of(seed: int, letters: str, n: int) -> str:
    """n words of 2 to 6 letters, drawn from 200 words, the first ones more often."""
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list(letters), rng.integers(2, 7))) for _ in range(200)]
    return " ".join(words[min(199, int(k))] for k in rng.exponential(40, n))


def test_a_tiny_sample_wins_no_other_language():
    en, fr = languages_of(1, "abcdefghijklmnop", 6000), languages_of(2, "abcdefghijklmnop", 6000)
    texts = [en[k : k + 300] for k in range(20_000, 23_000, 300)] + [fr[k : k + 300] for k in range(20_000, 23_000, 300)]
    for tiny in ("ok", "a", "abc def ghi jkl mno p abcde"):
        parser = CrossParser.of((("en", en[:20_000]), ("fr", fr[:20_000]), ("rare", tiny)))
        assert parser.predict(texts)[0] == ["en"] * 10 + ["fr"] * 10


def test_rows_without_letters_teach_nothing(spark):
    rows = [(k, languages_of(1, "abcdefgh", 50), "en") for k in range(40)] + [(k, text, "rare") for k, text in enumerate(["", " ", "12", None] * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert [lang for lang, _ in language_samples(docs)] == ["en"]
    assert {r.lang_pred for r in identify_language(docs).where("score > 0").collect()} == {"en"}


def test_scripts_of_thousands_of_characters():
    spans = {"en": range(97, 123), "hi": range(0x905, 0x93A), "ja": range(0x3041, 0x3097), "ko": range(0xAC00, 0xB800), "zh": range(0x4E00, 0x5C00)}
    rng = np.random.default_rng(3)
    texts = {}
    for lang, span in spans.items():
        words = ["".join(map(chr, rng.choice(list(span), 2))) for _ in range(3000)]
        texts[lang] = [" ".join(words[int(k) % 3000] for k in rng.exponential(600, 3000)) for _ in range(3)]
    parser = CrossParser.of(tuple((lang, own[0][: 1500 if lang in ("hi", "ko") else None]) for lang, own in texts.items()))
    for lang, own in texts.items():
        given = [t[at : at + 300] for t in own[1:] for at in range(0, 3000, 300)]
        assert parser.predict(given)[0] == [lang] * len(given)
    a, b = (chr(0x4E00 + k) for k in (1, 2))
    assert CrossParser.of((("x", f"{a}{b}{a}"),)).phrases([f"{a}{b}", f"{b}{b}", f"{a}{a}"]).tolist() == [[1], [2], [2]]


def many_languages(spark, languages=70):
    """Four labelled documents of each language, the first languages with more, and the texts to tell."""
    own = {f"l{k:02d}": languages_of(k, "abcdefghijkl", 1200).split() for k in range(languages)}
    rows = [(lang, " ".join(words[at * 200 : at * 200 + 200]), lang) for lang, words in own.items() for at in range(4)]
    rows += [(lang, " ".join(words[800:900]), lang) for lang, words in list(own.items())[:64]]
    rows += [("", " ".join(words[900:1200]), None) for lang, words in own.items()]
    rows = [(k, text, label) for k, (_, text, label) in enumerate(rows)]
    learnt = {label for k, _, label in rows if label and zlib.crc32(str(k).encode()) % 4 != 2}
    want = {rows[-languages + k][0]: lang for k, lang in enumerate(own) if lang in learnt}
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2), want


def test_every_language_is_learned(spark):
    docs, want = many_languages(spark)
    got = {r.doc_id: r.lang_pred for r in identify_language(docs).collect()}
    assert len(want) == 70 and {k: got[k] for k in want} == want


def test_passes_equal_one_pass(spark, edge_docs):
    docs, _ = many_languages(spark, 9)
    for table in (docs, edge_docs):
        one, three = (sorted(identify_language(table, n).collect(), key=str) for n in (1 << 30, 7000))
        assert [r[:3] for r in one] == [r[:3] for r in three]
        assert np.allclose([r.score for r in one], [r.score for r in three])
    key = lambda r: str(r)
    assert sorted(keep_known_language(edge_docs, 1).collect(), key=key) == sorted(keep_known_language(edge_docs).collect(), key=key)


def test_an_id_that_repeats_is_one_document(spark):
    texts = [languages_of(5, "abcdefgh", 40) for _ in range(600)]
    docs = spark.createDataFrame([(1, t, "en") for t in texts] + [(3, "xyz xyz", "rare")], "doc_id long, text string, lang string")
    assert [lang for lang, _ in language_samples(docs)] == ["en", "rare"]


def test_a_common_header_hides_no_text(spark):
    header = languages_of(1, "abcdefgh", 400)[:800]
    own = {"en": languages_of(1, "abcdefgh", 9000), "fr": languages_of(2, "abcdefgh", 9000)}
    rows = [(f"{header} {own[lang][at : at + 400]}" if lang == "fr" else own[lang][at : at + 400], lang) for lang in own for at in range(0, 16_000, 400)]
    rows += [(text[at : at + 200], None) for text in own.values() for at in range(20_000, 22_000, 200)]
    docs = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in identify_language(docs).collect()}
    assert [got[k] for k in range(80, 100)] == ["en"] * 10 + ["fr"] * 10


def test_an_unlabelled_corpus_is_kept(spark):
    texts = ["one two three", "日本語", "", None, "12 34"]
    docs = spark.createDataFrame([(k, t, None) for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in keep_known_language(docs).collect()) == [0, 1]
    assert {r.lang_pred for r in identify_language(docs).collect()} == {"und"}


def test_a_parser_takes_few_jobs(spark):
    """The driver keeps each job on record; there was one for each partition."""
    rows = [(k, f"text number {k} of language {k % 20}", f"l{k % 20:02d}") for k in range(200)]
    docs = sample_rows(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    (languages,), longest = sample_passes(docs)
    conf = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    # local relations and broadcasts aside, jobs are numbered one after the other
    last = lambda: max(spark.sparkContext.statusTracker().getJobIdsForGroup(None), default=-1)
    try:
        first = last()
        parser = pass_parser(docs, languages, longest)
        jobs = last() - first
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert parser.languages == sorted(languages) and len(languages) == 20
    assert jobs < 20
