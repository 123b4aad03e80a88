"""Connected components of an edge table, by alternating large and small stars.

Each round is grouped minima and equi-joins over edges; edge counts never
grow, a chain of length n needs O(log n) rounds, and minima combine before
the exchange.  Each round is written to the checkpoint folder, so a lost
executor costs one round at most.

The driver keeps a record of each task, and a job has many rounds: up to
``FEW_EDGES`` edges go to ``FEW_PARTS`` tasks an exchange, however many
partitions the session shuffles to; more edges go to all of them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import frozen

FEW_EDGES, FEW_PARTS = 1 << 19, 8


def _dealt(rows: DataFrame, few: bool) -> DataFrame:
    return rows.coalesce(FEW_PARTS) if few else rows


def _large_star(edges: DataFrame, few: bool = False) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = _dealt(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), few)
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, few: bool = False) -> DataFrame:
    """``edges`` point from larger to smaller nodes; they may repeat."""
    least = _dealt(edges.groupBy("a").agg(F.min("b").alias("m")), few)
    linked = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _dealt(linked.union(least.select("a", F.col("m").alias("b"))).distinct(), few)


def _all_stars(edges: DataFrame, few: bool) -> bool:
    """True if each node points to one root at most and no root points on: a round would change nothing."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("out"), F.lit(False).alias("met"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(True))).groupBy("x").agg(F.sum("out").alias("out"), F.max("met").alias("met"))
    return _dealt(ends, few).agg(F.count_if(F.expr("out > 1 OR out = 1 AND met"))).first()[0] == 0


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of each node with an edge; root is the component's least node, itself included.

    ``edges`` has two columns of one orderable type; loops, repeats and either
    direction are fine.  No edges give no rows.
    """
    a, b = edges.columns
    now = frozen(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    few = now.count() <= FEW_EDGES
    while not _all_stars(now, few):
        now = frozen(_small_star(_large_star(now, few), few))
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def least_labels(n: int, links: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least row reachable from each of n rows, within one task."""
    label = np.arange(n)
    changed = True
    while changed:
        before = label.copy()
        for a, b in links:
            low = np.minimum(label[a], label[b])
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
        label = label[label]
        changed = bool((label != before).any())
    return label
