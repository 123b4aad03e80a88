import zlib
from collections import Counter, defaultdict

import numpy as np

from daybook.llm.sharding import communication_matrix, hypergeometric, shard_report, shuffle_into_shards, write_shards


def test_hypergeometric_has_the_right_law():
    rng = np.random.default_rng(3)
    for good, total, drawn in ((5, 20, 7), (300, 1000, 100), (3, 3, 2), (0, 9, 4)):
        got = np.array([hypergeometric(rng, good, total, drawn) for _ in range(4000)])
        mean = drawn * good / total
        var = mean * (1 - good / total) * (total - drawn) / (total - 1)
        assert abs(got.mean() - mean) <= 5 * (var / 4000) ** 0.5 + 1e-9
        assert abs(got.var() - var) <= 0.15 * var + 1e-9
    assert abs(hypergeometric(rng, 10**11, 10**12, 10**9) - 10**8) < 10**6  # counts beyond any library's bound


def test_matrix_has_its_margins():
    rows, sizes = [0, 17, 400, 3], [105, 105, 105, 105]
    m = np.array(communication_matrix(rows, sizes, 1))
    assert m.sum(axis=1).tolist() == rows and m.sum(axis=0).tolist() == sizes


def check_dealt(rows, n, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[j]) for j in range(shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_edges(edge_docs, edge_rows):
    rows = shard_report(edge_docs).collect()
    check_dealt(rows, len(edge_rows), 24)
    want = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in edge_rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}


def test_uniform_small_blocks_and_any_input(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "cast(id AS string) AS text").repartition(7)
    rows = shuffle_into_shards(docs, shards=4, stored=False, rows_per_block=100).collect()
    check_dealt(rows, 4000, 4)
    for column in ("shard", "slot"):  # neither follows the id
        values = np.array([(r.doc_id, r[column]) for r in rows], dtype=float)
        assert abs(np.corrcoef(values.T)[0, 1]) < 0.08
    halves = Counter((r.shard, r.doc_id < 2000) for r in rows)
    assert all(420 < n < 580 for n in halves.values())


def test_fewer_rows_than_shards_and_empty(spark, no_docs):
    few = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    check_dealt(shuffle_into_shards(few, 24).collect(), 2, 24)
    assert shard_report(no_docs).count() == 0


def test_written_shards_hold_all_rows(spark, edge_docs, edge_rows, scratch):
    write_shards(shuffle_into_shards(edge_docs, 5), f"{scratch}/out")
    back = spark.read.parquet(f"{scratch}/out")
    assert back.count() == len(edge_rows) and set(back.columns) == set(edge_docs.columns)


def test_no_python_in_the_plan(edge_docs):
    plan = shard_report(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
