import re
import uuid

import pytest

import corpus_pipeline
from daybook.llm.toxicity import train
from test_prob_minhash import by_hand


@pytest.fixture(scope="module")
def stages(spark, sf_small, tmp_path_factory):
    """Rows that enter and leave each stage over the small tables."""
    root = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{sf_small}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = f"{root}/{uuid.uuid4().hex}"
        stage(spark, docs, sf_small).write.parquet(path)
        out.append((name, docs, spark.read.parquet(path)))
        docs = out[-1][2]
    return out


def test_order_and_columns(stages, spark, sf_small):
    assert [n for n, _, _ in stages] == ["language_id", "toxicity", "exact_dedup", "minhash_near_dedup", "best_fit_packing"]
    columns = spark.read.parquet(f"{sf_small}/documents.parquet").columns
    assert all(out.columns == columns for _, _, out in stages[:-1])


def test_language_and_toxicity_decide(stages, spark, sf_small):
    _, given, kept = stages[0]
    want = {r.doc_id for r in given.collect() if r.text and any(map(str.isalpha, r.text))}
    assert {r.doc_id for r in kept.collect()} == want
    _, given, kept = stages[1]
    scores = train(given, spark.read.parquet(f"{sf_small}/labels.parquet")).scorer()
    rows = given.collect()
    want = {r.doc_id for r, s in zip(rows, scores([r.text for r in rows])) if s < 0.3}
    assert {r.doc_id for r in kept.collect()} == want


def test_exact_and_near_equal_brute_force(stages):
    _, given, kept = stages[2]
    first = {}
    for r in sorted(given.collect(), key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text), r)
    assert sorted(kept.collect()) == sorted(first.values())
    _, given, kept = stages[3]
    rows = [(r.doc_id, r.text) for r in given.collect()]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for (i, _), c in zip(rows, by_hand(rows)) if i == c)


def test_all_that_is_left_is_packed(stages):
    _, given, packed = stages[4]
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in given.collect()}
    fill = packed.groupBy("sequence_id").sum("length").collect()
    assert max(r[1] for r in fill) <= 2048


def test_empty_table(spark, sf_small, tmp_path):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_small).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    assert docs.count() == 0


def test_registry_has_one_query_an_operator():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
