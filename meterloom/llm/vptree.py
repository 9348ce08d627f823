"""Nearest vectors by inner product with a vantage-point tree per shard.

Inner products order like distances once every vector gets one more coordinate that brings it to
the greatest norm, so the tree can use the triangle inequality. A node keeps a vantage point,
the nearer half of its vectors within a radius, the farther half beyond another. A half is left
out of a search if its smallest possible distance exceeds ``factor`` times the distance of the
k-th best found so far; factor one is exact, smaller ones leave out more. All queries of a
block go down a tree together, each into its own nearer half first.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterloom.llm.common import stage
from meterloom.llm.vectors import matrix, usable

K, FACTOR = 20, 0.2
#: Vectors of a tree, of a leaf, and queries of a block.
SHARD, LEAF, QUERIES, SEED = 10_000, 100, 20_000, 3


def build(x: np.ndarray, leaf: int = LEAF, seed: int = SEED):
    """A tree over the rows of ``x``: a leaf is an array of row numbers, a node (vantage point,
    greatest inner distance, smallest outer distance, inner, outer)."""
    rng = np.random.default_rng(seed)

    def grow(rows: np.ndarray):
        if len(rows) <= leaf:
            return rows
        tried = rng.choice(rows, min(4, len(rows)), replace=False)
        seen = x[rng.choice(rows, min(64, len(rows)), replace=False)]
        spread = [np.linalg.norm(seen - x[t], axis=1).std() for t in tried]
        point = x[tried[int(np.argmax(spread))]]
        d = np.linalg.norm(x[rows] - point, axis=1)
        half = len(rows) // 2
        order = np.argpartition(d, half)
        near, far = order[:half], order[half:]
        return point, d[near].max(), d[far].min(), grow(rows[near]), grow(rows[far])

    return grow(np.arange(len(x)))


def search(tree, x: np.ndarray, q: np.ndarray, own: np.ndarray, names: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """Query and row numbers of the candidates found: the k nearest, and all as near as the last of
    them up to rounding. A row whose name is the query's own is none."""
    best = np.full((len(q), k), np.inf)  # squared distances
    q2, x2 = (q * q).sum(1), (x * x).sum(1)
    # What rounding may move a squared distance that is a difference of such norms.
    slack = 1e-12 * (q2 + x2.max(initial=0.0))
    hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def visit(node, active: np.ndarray) -> None:
        if len(active) == 0:
            return
        if isinstance(node, np.ndarray):
            d = q2[active][:, None] + x2[node] - 2 * q[active] @ x[node].T
            d[own[active][:, None] == names[node]] = np.inf
            every = np.concatenate([best[active], d], 1)
            best[active] = np.partition(every, k - 1, axis=1)[:, :k]
            row, col = np.nonzero(d <= (best[active].max(1) + slack[active])[:, None])
            some = np.isfinite(d[row, col])
            hits.append((active[row[some]], node[col[some]], d[row[some], col[some]]))
            return
        point, inner, outer, near, far = node
        d = np.linalg.norm(q[active] - point, axis=1)
        inside = d - inner < outer - d
        first, second = active[inside], active[~inside]
        visit(near, first)
        visit(far, second)
        reach = lambda a: np.sqrt(np.maximum(best[a].max(1) + slack[a], 0))
        visit(far, first[outer - d[inside] <= factor * reach(first) + 1e-12])
        visit(near, second[d[~inside] - inner <= factor * reach(second) + 1e-12])

    visit(tree, np.arange(len(q)))
    if not hits:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    query, row, d = (np.concatenate(part) for part in zip(*hits, strict=True))
    kept = d <= best[query].max(1) + slack[query]
    return query[kept], row[kept]


def _lifted(x: np.ndarray, norm: float) -> np.ndarray:
    return np.column_stack([x, np.sqrt(np.maximum(norm * norm - (x * x).sum(1), 0))])


def _plant(table: pa.Table, norm: float) -> pa.Table:
    x = matrix(table.column("embedding"))
    blob = pickle.dumps((np.asarray(table.column("vec_id")), x, build(_lifted(x, norm))))
    return pa.table({"size": table.column("size").slice(0, 1), "shard": table.column("shard").slice(0, 1), "tree": pa.array([blob], pa.binary())})


_FOUND = "query_id long, vec_id long, score double, place long"


def _ask(trees: pa.Table, queries: pa.Table, norm: float, k: int, factor: float) -> pa.Table:
    empty = {"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64()), "place": pa.array([], pa.int64())}
    if len(trees) == 0 or len(queries) == 0:
        return pa.table(empty)
    ids, x, tree = pickle.loads(trees.column("tree")[0].as_py())
    q, names = matrix(queries.column("embedding")), np.asarray(queries.column("query_id"))
    place = np.asarray(queries.column("place"))
    row, hit = search(tree, _lifted(x, norm), np.column_stack([q, np.zeros(len(q))]), names, ids, min(k, len(ids)), factor)
    score = (x[hit] * q[row]).sum(1)  # the same sum for equal vectors, wherever they stand
    return pa.table(
        {"query_id": pa.array(names[row]), "vec_id": pa.array(ids[hit]), "score": pa.array(score), "place": pa.array(place[row])}
    )


def nearest(
    embeddings: DataFrame,
    queries: DataFrame,
    k: int = K,
    factor: float = FACTOR,
    shard: int = SHARD,
    block: int = QUERIES,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: for every row of ``queries`` the
    ``k`` rows of ``embeddings`` with the largest inner product, ties to the smaller ``vec_id``,
    rows with the query's own id left out, whatever their vector; fewer if there are fewer.

    Null or zero vectors, ones with null or non-finite components and rows without an id take no
    part; vectors of another length than the query's are not its candidates. Of equal vectors
    only the ``k + 1`` smallest ids are indexed: no other one can be among the nearest. Rows
    that repeat an id with the same vector are one row; with different vectors they are asked and
    found separately. Other columns are ignored. An empty table gives no rows.
    """
    kinds = lambda df: df.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    ).filter(usable("embedding") & F.col("vec_id").isNotNull())
    equal = Window.partitionBy("embedding").orderBy("vec_id")
    points = stage(
        kinds(embeddings)
        .dropDuplicates(["vec_id", "embedding"])
        .withColumn("n", F.row_number().over(equal))
        .filter(F.col("n") <= k + 1)
        .select("vec_id", "embedding", F.size("embedding").alias("size")),
        "vp-points",
    )
    facts = points.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v * v)).alias("m")
    ).first()
    norm = math.sqrt(facts["m"] or 0.0)
    shards = max(1, math.ceil(facts["n"] / shard))
    trees = stage(
        points.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
        .groupBy("size", "shard")
        .applyInArrow(lambda t: _plant(t, norm), "size int, shard int, tree binary"),
        "vp-trees",
    )
    asked = stage(
        kinds(queries)
        .dropDuplicates(["vec_id", "embedding"])
        .select(F.col("vec_id").alias("query_id"), "embedding", F.size("embedding").alias("size"), F.xxhash64("embedding").alias("place")),
        "vp-queries",
    )
    blocks = max(1, math.ceil(asked.count() / block))
    left = trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    )
    per = ("size", "shard", "block")
    found = (
        left.groupBy(*per).cogroup(right.groupBy(*per)).applyInArrow(lambda t, q: _ask(t, q, norm, k, factor), _FOUND)
    )
    best = Window.partitionBy("query_id", "place").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
