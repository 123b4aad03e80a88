import re
from collections import defaultdict

from pyspark.sql import functions as F

from daybook.llm.exact_dedup import drop_copies, exact_dedup, sha256_hex


def by_hand(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")].append(r[0])
    out = []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out += [(i, keep, len(ids), i == keep) for i in ids]
    return sorted(out, key=str)


def weak(text):
    return F.length(text).cast("string")  # many different texts share this digest


def test_edges_and_weak_digest(edge_docs, edge_rows):
    for digest in (sha256_hex, weak):
        got = exact_dedup(edge_docs, digest, salts=3).collect()
        assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got), key=str) == by_hand(edge_rows)
        assert all(len(r.text_sha256) == 64 for r in got)


def test_drop_copies_keeps_one_row_a_text_and_all_columns(edge_docs, edge_rows):
    for digest in (sha256_hex, weak):
        kept = drop_copies(edge_docs, digest)
        assert kept.columns == edge_docs.columns
        rows = kept.collect()
        assert len(rows) == len({re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in edge_rows})
        assert {r.doc_id for r in rows} == {3, 8, 2, 7, None, 11, 12, 13, 14, 100}
        assert all(r.keep_id == "x" for r in rows)


def test_empty_table(no_docs):
    assert exact_dedup(no_docs).count() == 0
    assert drop_copies(no_docs).count() == 0


def test_hot_text_combines_before_the_exchange(edge_docs):
    from daybook.llm.exact_dedup import content_classes

    plan = content_classes(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") + plan.count("SortAggregate") >= 3  # local, salted, global


def test_hot_digests_meet_their_class_in_several_places(spark):
    rows = [(k, f"copy {k % 2}") for k in range(4000)] + [(k, f"own text {k}") for k in range(4000, 4500)] + [(None, "copy 1"), (7, "copy 1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(docs).collect()), key=str)
    assert got == by_hand(rows)
    assert {r.doc_id for r in drop_copies(docs).collect()} == {0, 1, *range(4000, 4500)}
