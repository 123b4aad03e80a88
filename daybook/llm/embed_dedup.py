"""Near-dedup of embeddings: int8 tile products, then full precision where it matters.

Equal vectors of a label first become one representative with a count, so
copies never multiply pairs.  The representatives of a label are dealt into
tiles of about ``TILE_ROWS`` rows, and one task takes each pair of tiles:

* every unit vector u is quantised to u' = s q, q an int8 vector, and its
  error e = |u - u'| is measured, not assumed;
* u.v differs from u'.v' by at most e_u |v'| + e_v |u| (Cauchy-Schwarz), so
  the product of the int8 tiles, exact in float32, bounds each cosine;
* only pairs whose upper bound reaches the threshold are computed in double
  precision, and these alone decide.

A task returns no pairs: it returns each row's number of links (weighted by
copies) and a spanning forest of its links, at most a row per vector, from
which the components follow.  Labels never mix.

Comparing all rows of a label is quadratic in the label's size by contract;
tiles split a hot label over as many tasks as it has tile pairs.

Cases: a null label or vector, a zero vector and one with null or non-finite
components link with nothing; vectors of different length never link; rows
that repeat a vector are linked with one another; a null vec_id is a vector
like others but never names a component unless all its members are null; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import batch_rows, frozen
from daybook.llm.components import connected_components, least_labels

THRESHOLD = 0.98
TILE_ROWS = 2048
#: Rows of one product block; bounds a task's memory at BLOCK x TILE_ROWS floats.
BLOCK = 512
#: Dimensions per int8 product: 127 * 127 * 1024 < 2**24, so float32 sums stay exact.
EXACT_DIMS = 1024
#: Slack for rounding in double precision, far above dims * 2**-52.
ROUNDING = 1e-9


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(q, s, e, n) of unit rows u = x / |x|: int8 codes, scale, |u - s q| and |s q|."""
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    scale = np.abs(unit).max(axis=1) / 127.0
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    back = q * scale[:, None]
    return q, scale, np.linalg.norm(unit - back, axis=1), np.linalg.norm(back, axis=1)


def upper_bounds(a: tuple, b: tuple) -> np.ndarray:
    """Upper bounds of the cosines between the rows of two quantised blocks."""
    (qa, sa, ea, _), (qb, sb, eb, nb) = a, b
    product = np.zeros((len(qa), len(qb)))
    for d in range(0, qa.shape[1], EXACT_DIMS):
        product += qa[:, d : d + EXACT_DIMS].astype(np.float32) @ qb[:, d : d + EXACT_DIMS].astype(np.float32).T
    product *= sa[:, None] * sb[None, :]
    product += ea[:, None] * nb[None, :]
    product += eb[None, :] + ROUNDING
    return product


def links_between(x: np.ndarray, y: np.ndarray, same: bool, threshold: float):
    """Yield arrays (i, j) of rows of x and y with cosine >= threshold; i < j when x is y."""
    if not len(x) or not len(y):
        return
    qx, qy = quantise(x), quantise(y)
    nx, ny = np.sqrt((x * x).sum(axis=1)), np.sqrt((y * y).sum(axis=1))
    for top in range(0, len(x), BLOCK):
        part = tuple(v[top : top + BLOCK] for v in qx)
        i, j = np.nonzero(upper_bounds(part, qy) >= threshold)
        i += top
        if same:
            i, j = i[i < j], j[i < j]
        for at in range(0, len(i), 1 << 15):
            a, b = i[at : at + (1 << 15)], j[at : at + (1 << 15)]
            sure = np.einsum("rd,rd->r", x[a], y[b]) / (nx[a] * ny[b]) >= threshold
            if sure.any():
                yield a[sure], b[sure]


def _tile_pair(threshold: float):
    def work(rows: pa.Table) -> pa.Table:
        first = rows["_first"].to_numpy(zero_copy_only=False)
        rows = rows.take(pa.array(np.argsort(~first, kind="stable")))
        node, copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
        dims = len(rows["embedding"][0].as_py())
        x = np.asarray(rows["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dims)
        n, cut, same = len(node), int(first.sum()), bool(rows["_same"][0].as_py())
        count, links = np.zeros(n, dtype=np.int64), []
        for a, b in links_between(x, x, True, threshold) if same else ((a, b + cut) for a, b in links_between(x[:cut], x[cut:], False, threshold)):
            np.add.at(count, a, copies[b])
            np.add.at(count, b, copies[a])
            links.append((a, b))
        root = least_labels(n, links)
        linked = np.flatnonzero(count)
        return pa.table({"node": pa.array(node[linked], pa.int64()), "links": pa.array(count[linked], pa.int64()), "root": pa.array(node[root[linked]], pa.int64())})

    return work


def embedding_near_dups(vectors: DataFrame, threshold: float = THRESHOLD, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of (vec_id, embedding, label)."""
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.col("label").isNotNull() & e.isNotNull() & finite & F.exists(e, lambda x: x != 0)
    rows = vectors.select("vec_id", "embedding", "label").withColumn("_usable", F.coalesce(usable, F.lit(False)))
    content = ["label", "embedding"]
    classes = rows.where("_usable").groupBy(*content).agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies"))
    reps = frozen(classes.withColumn("node", F.monotonically_increasing_id()).withColumn("dims", F.size("embedding")))

    within = ["label", "dims"]
    tiles = reps.groupBy(*within).agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("int").alias("_tiles"))
    dealt = reps.select(*within, "node", "copies", "embedding").join(tiles, within).withColumn("_tile", F.pmod(F.xxhash64("node"), F.col("_tiles")).cast("int"))
    paired = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)))
    paired = paired.select(
        *within, "node", "copies", "embedding",
        F.least("_tile", "_other").alias("_a"), F.greatest("_tile", "_other").alias("_b"),
        (F.col("_tile") <= F.col("_other")).alias("_first"), (F.col("_tile") == F.col("_other")).alias("_same"),
    )
    pair_key = [*within, "_a", "_b"]
    found = frozen(batch_rows(paired).groupBy(*pair_key).applyInArrow(_tile_pair(threshold), "node long, links long, root long"))

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select("node", "root"))
    ids = reps.select("node", "least_id").join(parts, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = ids.groupBy("root").agg(F.min("least_id").alias("component_id"))
    per_class = reps.join(links, "node", "left").join(ids.select("node", "root"), "node").join(named, "root")
    per_class = per_class.select(*content, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")

    linked = rows.where("_usable").join(per_class, content).select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT _usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
