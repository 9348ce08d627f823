"""Operators on vectors, against brute force."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from meterloom.llm import components, sorted_projection, vptree

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed: int = 1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((40, 16))
    rows = [(k, (centres[k % 40] + 0.03 * rng.standard_normal(16)).astype(np.float32).tolist(), int(k % 40 % 4)) for k in range(600)]
    rows += [(1000 + k, rows[0][1], 0) for k in range(60)]
    return rows


ODD = [(2000, None, 1), (2020, [0.0] * 16, 1), (2040, [float("nan")] + [1.0] * 15, 1), (2060, [None] + [1.0] * 15, 1), (2080, [1.0] * 16, None), (2100, [1.0, 2.0], 2), (2120, [1.0, 2.0], 2), (None, [1.0] * 16, 1)]


def test_links_equal_brute_force(spark):
    rows = vectors()
    frame = spark.createDataFrame([*rows, *ODD], SCHEMA).withColumn("rep", F.lit("clash"))
    got = {r.vec_id: r for r in sorted_projection.near_vectors(frame, block=64).collect()}
    x = np.array([r[1] for r in rows], np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    label, ids = np.array([r[2] for r in rows]), np.array([r[0] for r in rows])
    near = (x @ x.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    assert [got[i].n_links for i in ids] == near.sum(1).tolist()
    reach = near | np.eye(len(ids), dtype=bool)
    while (wider := (reach.astype(float) @ reach) > 0).sum() > reach.sum():
        reach = wider
    assert [got[i].component_id for i in ids] == [int(ids[r].min()) for r in reach]
    assert all(got[i].n_links == 0 and got[i].kept for i in (2000, 2020, 2040, 2060, 2080))
    assert got[2120].component_id == 2100 and sorted_projection.near_vectors(frame.limit(0)).count() == 0


def test_nearest_with_factor_one_is_exact_and_the_default_close(spark):
    rows = vectors(2)
    frame = spark.createDataFrame([*rows, *ODD], SCHEMA).withColumn("rank", F.lit("clash"))
    asked = frame.filter("vec_id % 20 = 0")
    x, ids = np.array([r[1] for r in rows], np.float64), np.array([r[0] for r in rows])
    want = {}
    for q in np.flatnonzero(ids % 20 == 0):
        s = (x * x[q]).sum(1)
        order = [k for k in np.lexsort((ids, -s)) if k != q][:20]
        want[int(ids[q])] = [int(ids[k]) for k in order]
    exact, close = {}, {}
    for out, factor in ((exact, 1.0), (close, vptree.FACTOR)):
        for r in vptree.nearest(frame, asked, factor=factor, shard=200).orderBy("query_id", "rank").collect():
            out.setdefault(r.query_id, []).append(r.vec_id)
    assert {q: exact[q] for q in want} == want
    assert exact[2100] == [2120] and exact[2120] == [2100] and 2000 not in exact
    hits = sum(len(set(close[q]) & set(want[q])) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert vptree.nearest(frame.limit(0), asked.limit(0)).count() == 0


def test_ties_go_to_smaller_ids_in_one_shard_and_repeated_ids_are_left_out(spark):
    rng = np.random.default_rng(9)
    base = rng.standard_normal(16)
    rows = [(k, base.astype(np.float32).tolist()) for k in range(1, 61)]
    rows += [(100 + 20 * k, (base + 1e-3 * rng.standard_normal(16)).astype(np.float32).tolist()) for k in range(5)]
    rows += [(500 + k, rng.standard_normal(16).astype(np.float32).tolist()) for k in range(300)]
    rows += [(120, rows[0][1]), (120, rows[70][1])]  # an id with three vectors
    rows += [(1000 + k, np.eye(16, dtype=np.float32)[k % 16].tolist()) for k in range(64)]  # ties between different vectors
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asked = [(r[0], np.array(r[1], np.float64)) for r in rows if r[0] % 20 == 0]
    asked.append((2000, np.ones(16)))
    queries = spark.createDataFrame([(i, q.tolist()) for i, q in asked], "vec_id long, embedding array<double>")
    got = {}
    for r in vptree.nearest(frame, queries, factor=1.0).orderBy("rank").collect():
        got.setdefault((r.query_id, r["rank"]), []).append(r.vec_id)
    want = {}
    for i, q in asked:
        near = sorted({(-float((np.array(v, np.float64) * q).sum()), k, tuple(v)) for k, v in rows if k != i})[:20]
        for rank, (_, k, _) in enumerate(near, 1):
            want.setdefault((i, rank), []).append(k)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(1, 200)] + [(1000, 1000 + k) for k in range(1, 50)] + [(5000, 5000), (None, 3)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[k] == 1 for k in range(1, 201)) and all(got[1000 + k] == 1000 for k in range(50)) and 5000 not in got


def test_crowded_and_off_centre_labels_are_compared_whole(spark):
    rng = np.random.default_rng(7)

    def around(n: int, mean_cosine: float) -> np.ndarray:
        noise = rng.standard_normal((n, 64)) / 8 * np.sqrt(1 / mean_cosine - 1)
        noise[:, 0] += 1
        return noise

    crowd, off = around(3000, 0.965), around(2000, 0.7)
    off[1000:1200] = off[:200] + 0.015 * rng.standard_normal((200, 64))  # isolated pairs
    x = np.concatenate([crowd, off]).astype(np.float32)
    label = np.repeat([0, 1], [3000, 2000])
    frame = spark.createDataFrame([(k, v.tolist(), int(c)) for k, (v, c) in enumerate(zip(x, label, strict=True))], SCHEMA)
    got = sorted(sorted_projection.near_vectors(frame).collect(), key=lambda r: r.vec_id)
    x = x.astype(np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = (x @ x.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    assert near[:3000].sum() > 1000 and near[3000:].sum() > 300
    assert [r.n_links for r in got] == near.sum(1).tolist()
    root = np.arange(len(x))
    for a, b in np.argwhere(near):  # links are few; merge the larger root into the smaller
        low, high = sorted((root[a], root[b]))
        root[root == high] = low
    assert [r.component_id for r in got] == root.tolist()
