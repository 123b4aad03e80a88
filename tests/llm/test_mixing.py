from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from daybook.llm.mixing import MOST, mix_plan, mixed, repeated, source_targets
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"


def words(text) -> int:
    for c in SPACE:
        text = (text or "").replace(c, " ")
    return sum(1 for w in text.split(" ") if w)


def targets(sizes: dict) -> dict:
    """The excess over three sizes is shared again, round by round, as the contract words it."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    left, open_, out = Fraction(sum(sizes.values())), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > MOST * sizes[s]}
        for s in over:
            out[s] = Fraction(MOST * sizes[s])
            left -= out[s]
        open_ -= over
        if not over:
            return {**out, **share}
    return out


def check(rows, given):
    sizes = defaultdict(int)
    for _, text, source in given:
        sizes[source] += words(text)
    want = targets(sizes)
    assert Counter((r.doc_id, r.source, r.size) for r in rows) == Counter((i, s, words(t)) for i, t, s in given)
    taken, largest = Counter(), Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(float(want[r.source]))
        assert r.taken == r.copies * r.size and 0 <= r.copies <= MOST
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * largest[s] + 1e-3 * float(want[s]), s
    return taken, want


def mix(spark, rows, partitions=3):
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(partitions)


def test_targets_and_words_come_near(spark):
    rows = [(k, "w " * (1 + k * k % 97), f"s{k % 7 if k % 3 else 0}") for k in range(4000)]
    rows += [(k, "v", "tiny") for k in range(5000, 5020)]
    taken, want = check(mix_plan(mix(spark, rows)).collect(), rows)
    assert taken["tiny"] == want["tiny"] == MOST * 20  # at its most: every document three times


def test_reruns_and_partitions_agree(spark):
    rows = [(k % 900, "w " * (k % 13), f"s{k % 4}") for k in range(1000)]
    first, again = (sorted(mix_plan(mix(spark, rows, n)).collect()) for n in (2, 9))
    assert first == again


def test_water_level_in_several_rounds(spark):
    sizes = {"a": 1000, "b": 1, "c": 7, "d": 50, "e": 90, None: 400}
    rows = spark.createDataFrame([(("1" if s is None else "0" + s), n, 1) for s, n in sizes.items()], "_source string, size long, _n long")
    got = {r._source: r.target for r in source_targets(rows).collect()}
    want = targets(sizes)
    assert got == {("1" if s is None else "0" + s): pytest.approx(float(t)) for s, t in want.items()}
    assert sum(t >= MOST * sizes[s] for s, t in want.items()) >= 3


def test_hot_identical_rows(spark):
    rows = [(None, "hot text here", "a")] * 3000 + [(k, "one", "a") for k in range(100)] + [(k, "two words", "b") for k in range(10)]
    check(mix_plan(mix(spark, rows)).collect(), rows)


def test_mixed_emits_whole_rows(spark):
    rows = [(k % 250, f"text {k % 250}" + " w" * (k % 11), f"s{k % 3}") for k in range(300)]  # 50 rows are there twice
    rows += [(None, None, None), (7, "text 7", None)]
    docs = mix(spark, rows).withColumn("copy", F.lit("clash")).withColumn("size", F.lit("kept"))
    out = mixed(docs).collect()
    plan = Counter()
    for r in mix_plan(docs).collect():
        plan[r.doc_id, r.source, r.size] += r.copies
    assert Counter((r.doc_id, r.source, words(r.text)) for r in out) == +plan
    assert {r["size"] for r in out} == {"kept"} and len({(r.doc_id, r.source, r.text, r.copy) for r in out}) == len(out)


def test_edges(spark, edge_docs, edge_rows, no_docs):
    check(mix_plan(edge_docs).collect(), [(r[0], r[1], r[3]) for r in edge_rows])
    assert mix_plan(no_docs).count() == 0 and mixed(no_docs).count() == 0
    assert [r.taken for r in mix_plan(mix(spark, [(1, None, "a"), (2, " ", None)])).collect()] == [0, 0]


def test_long_runs_are_split(spark):
    rows = repeated(spark.range(1), F.lit((1 << 20) + 5), "k")
    assert rows.agg(F.min("k"), F.max("k"), F.count_distinct("k")).first() == (0, (1 << 20) + 4, (1 << 20) + 5)


def test_no_python_in_the_plan(edge_docs):
    for df in (mix_plan(edge_docs), mixed(edge_docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
