import random

import pytest

from daybook.llm import components
from daybook.llm.components import connected_components


def test_equal_union_find(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(300, 420)] + [(rng.randrange(250), rng.randrange(250)) for _ in range(140)]
    edges += [(1000, 1000 + k) for k in range(200)] + [(7, 7), (5, 5)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert got == {x: find(x) for x in root}


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "x long, y long")).count() == 0
    assert connected_components(spark.createDataFrame([(4, 4)], "x long, y long")).count() == 0


@pytest.fixture
def many_partitions(spark):
    """A session that shuffles to 60 partitions and leaves them as they are."""
    conf = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def tasks_of(spark, work):
    """Tasks of the jobs that ``work`` ran."""
    sc, group = spark.sparkContext, f"counted {work.__name__}"
    sc.setJobGroup(group, group)
    try:
        work()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    status = sc.statusTracker()
    stages = {s for j in status.getJobIdsForGroup(group) for s in status.getJobInfo(j).stageIds}
    return sum(x.numCompletedTasks for x in map(status.getStageInfo, stages) if x)


def test_a_round_over_few_edges_has_few_tasks(many_partitions):
    """The driver keeps each task on record."""
    edges = many_partitions.createDataFrame([(k + 1, k) for k in range(300)], "a long, b long")

    def rounds():
        assert connected_components(edges).where("root = 0").count() == 301

    assert tasks_of(many_partitions, rounds) < 1200  # 5 or so rounds; each had some 7 * 60 tasks


def test_more_edges_go_to_all_partitions(many_partitions, monkeypatch):
    monkeypatch.setattr(components, "FEW_EDGES", 10)
    edges = many_partitions.createDataFrame([(k + 1, k) for k in range(40)] + [(100, k) for k in range(101, 120)], "a long, b long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 120), 100)}
