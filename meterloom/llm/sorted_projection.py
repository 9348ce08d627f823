"""Near-duplicate vectors by sorted projection passes.

A pass gives every vector the signs of its products with random planes, concatenated to one
number, sorts by label and that number, and compares each vector with the next ``WINDOW`` ones.
The planes go through the mean of the label's directions, and a label takes as many passes as
its size and its spread around the mean need for ``RECALL``; where that is more than comparing
the label whole, it is compared whole. The passes only gather: vectors that some window shows
within ``LOOSE`` are one group, and every pair of a group is compared, block against block. So
neither links nor components depend on the windows where vectors stand crowded. Equal vectors
are one class with a count and are compared once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import broadcast_if_small, stage
from meterloom.llm.components import components
from meterloom.llm.vectors import matrix, usable

COSINE = 0.98
#: Cosine from which vectors are one group; share of isolated links that the passes should show.
LOOSE, RECALL = 0.8, 0.9995
#: Passes at least.
PASSES, BITS, WINDOW, SEED = 16, 48, 16, 5
#: Vectors of a group that are compared as one block.
BLOCK = 512


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest of ``n`` places that each place reaches by the links ``a``, ``b``."""
    root = np.arange(n)
    while (root[a] != root[b]).any():
        left, right = root[a], root[b]
        low = np.minimum(left, right)
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        while (root[root] != root).any():
            root = root[root]
    return root


def _sums(batches) -> Iterator[pa.RecordBatch]:
    """Per label and length, the number of vectors and the sum of their directions."""
    for batch in batches:
        label, offsets = np.asarray(batch.column(0)), np.asarray(batch.column(1).offsets)
        out = []
        for size in np.unique(lengths := np.diff(offsets)):
            at = np.flatnonzero(lengths == size)
            x = matrix(batch.column(1).take(pa.array(at)))
            x = x / np.linalg.norm(x, axis=1)[:, None]
            found, place = np.unique(label[at], return_inverse=True)
            total = np.zeros((len(found), int(size)))
            np.add.at(total, place, x)
            out += [(k, int(size), n, t) for k, n, t in zip(found, np.bincount(place), total, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([int(o[0]) for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int32()),
                pa.array([int(o[2]) for o in out], pa.int64()), pa.array([o[3] for o in out], pa.list_(pa.float64())),
            ],
            names=["label", "size", "n", "total"],
        )


def _needed(n: Column, square: Column, cosine: float, window: int) -> Column:
    """Passes that show an isolated link with ``RECALL`` (null: no number does), for ``n``
    vectors whose mean direction has the squared length ``square``."""
    spread = F.sqrt(F.greatest(1 - square, F.lit(0.0)))
    half = F.when(spread > 0, F.least(F.lit(math.sqrt((1 - cosine) / 2)) / spread, F.lit(1.0))).otherwise(1.0)
    agree = 1 - 2 * F.asin(half) / math.pi
    shown = F.pow(agree, F.greatest(F.log2(n / window), F.lit(0.0)))
    return F.when(shown >= 1, 1).when(shown > 1e-9, F.ceil(math.log(1 - RECALL) / F.log1p(-shown)))


def _keys(batches, bits: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Every vector once per pass of its label, with the pass's key."""
    planes: dict[tuple[int, int], np.ndarray] = {}
    weights = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
    for batch in batches:
        lengths = np.diff(np.asarray(batch.column(2).offsets))
        for size in np.unique(lengths):
            part = batch.take(pa.array(np.flatnonzero(lengths == size)))
            x, passes = matrix(part.column(2)), np.asarray(part.column(4))
            x = x / np.linalg.norm(x, axis=1)[:, None] - matrix(part.column(3))
            for p in range(passes.max()):
                if (size, p) not in planes:
                    planes[size, p] = np.random.default_rng((seed, int(size), p)).standard_normal((int(size), bits))
                at = np.flatnonzero(passes > p)
                rows = part if len(at) == len(x) else part.take(pa.array(at))
                keys = (x[at] @ planes[size, p] > 0) @ weights
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), p, np.int32)), rows.column(1), pa.array(keys), rows.column(0), rows.column(2)],
                    names=["pass", "label", "key", "rep", "embedding"],
                )


_LINKS = "a long, b long, pass int, label long, key long, rep long, embedding array<double>"


def _windows(batches, window: int, cosine: float) -> Iterator[pa.RecordBatch]:
    """A forest of the links between a row and the ``window`` rows before it, across batches of
    a partition (``a``, ``b``), and the partition's first and last ``window`` rows."""
    links = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    none = lambda n: [pa.nulls(n, pa.int32()), *[pa.nulls(n, pa.int64())] * 3, pa.nulls(n, pa.list_(pa.float64()))]
    names = [c.split(" ")[0] for c in _LINKS.split(", ")]
    held, first = None, 0
    for batch in batches:
        if first < window:
            edge = batch.slice(0, window - first)
            first += len(edge)
            yield pa.RecordBatch.from_arrays([*[pa.nulls(len(edge), t) for t in links.types], *edge.columns], names=names)
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        group, label, rep = (np.asarray(batch.column(k)) for k in (0, 1, 3))
        lengths = np.diff(np.asarray(batch.column(4).offsets))
        if len(np.unique(lengths)) > 1:  # vectors of several lengths: only equal ones compare
            x = np.zeros((len(rep), lengths.max()))
            for i, v in enumerate(batch.column(4)):
                x[i, : lengths[i]] = np.asarray(v.values)
        else:
            x = matrix(batch.column(4))
        x = x / np.linalg.norm(x, axis=1)[:, None]
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for j in range(1, min(window, len(rep) - 1) + 1):
            near = np.flatnonzero(
                (group[j:] == group[:-j]) & (label[j:] == label[:-j]) & (lengths[j:] == lengths[:-j])
                & (np.einsum("ij,ij->i", x[j:], x[:-j]) >= cosine)
            )
            a.append(near)
            b.append(near + j)
        root = _forest(len(rep), np.concatenate(a), np.concatenate(b))
        at = np.flatnonzero(rep[root] != rep)
        yield pa.RecordBatch.from_arrays([pa.array(rep[root[at]]), pa.array(rep[at]), *none(len(at))], names=names)
        held = batch.slice(max(0, len(rep) - window))
    if held is not None:
        yield pa.RecordBatch.from_arrays([*[pa.nulls(len(held), t) for t in links.types], *held.columns], names=names)


def _count(table: pa.Table, cosine: float) -> pa.Table:
    """Links of each vector to the other block, or within its own, weighted by class sizes, and
    a vector that it reaches by them."""
    table = table.sort_by([("comp", "ascending"), ("i", "ascending"), ("j", "ascending"), ("side", "ascending")])
    comp, i, j, side, rep, weight = (np.asarray(table.column(c)) for c in ("comp", "i", "j", "side", "rep", "weight"))
    vectors = table.column("embedding").combine_chunks()
    lengths = np.asarray(vectors.value_lengths())
    cuts = np.flatnonzero((np.diff(comp) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
    out_n, out_root = np.zeros(len(rep), np.int64), rep.copy()
    for both in np.split(np.arange(len(rep)), cuts):
        for size in np.unique(lengths[both]):
            at = both[lengths[both] == size]
            x = matrix(vectors.take(pa.array(at)))
            x = x / np.linalg.norm(x, axis=1)[:, None]
            if i[at[0]] == j[at[0]]:
                near = x @ x.T >= cosine
                np.fill_diagonal(near, False)
                out_n[at] += near @ weight[at]
                root = _forest(len(at), *np.nonzero(near))
            else:
                left, right = np.flatnonzero(side[at] == 0), np.flatnonzero(side[at] == 1)
                near = x[left] @ x[right].T >= cosine
                out_n[at[left]] += near @ weight[at[right]]
                out_n[at[right]] += near.T @ weight[at[left]]
                a, b = np.nonzero(near)
                root = _forest(len(at), left[a], right[b])
            out_root[at] = rep[at[root]]
    return pa.table({"rep": pa.array(rep), "n": pa.array(out_n), "root": pa.array(out_root)})


def near_vectors(
    embeddings: DataFrame,
    cosine: float = COSINE,
    passes: int = PASSES,
    bits: int = BITS,
    window: int = WINDOW,
    seed: int = SEED,
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links`` (other vectors linked directly),
    ``component_id`` (smallest ``vec_id`` reachable), ``kept`` (it is that one).

    Vectors link if their labels are equal and not null and their cosine reaches ``cosine``.
    Null or zero vectors, ones with null or non-finite components, null labels and null ids
    link with nothing; vectors of different lengths do not link. Equal vectors always do, also
    rows that repeat an id. Other columns are ignored. No rows, no rows.
    """
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("long").alias("label")
    )
    valid = rows.filter(usable("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    classes = stage(
        valid.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight")),
        "projection-classes",
    ).withColumn("size", F.size("embedding"))
    sums = classes.select("label", "embedding").mapInArrow(_sums, "label long, size int, n long, total array<double>")
    means = (
        sums.select("label", "size", "n", F.posexplode("total").alias("at", "total"))
        .groupBy("label", "size", "at")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        .groupBy("label", "size")
        .agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("at", (F.col("total") / F.col("n")).alias("mean")))).alias("mean"))
        .withColumn("mean", F.col("mean.mean"))
    )
    square = F.aggregate("mean", F.lit(0.0), lambda s, m: s + m * m)
    labels = broadcast_if_small(
        stage(
            means.withColumn("needed", F.greatest(_needed(F.col("n"), square, cosine, window), F.lit(passes)).cast("long"))
            .withColumn("needed", F.when(_needed(F.col("n"), square, cosine, window).isNotNull(), F.col("needed")))
            # Rows that passes make, against rows that blocks of the whole label make.
            .withColumn("whole", F.col("needed").isNull() | ((F.col("needed") > passes) & (F.ceil(F.col("n") / block) <= F.col("needed")))),
            "projection-labels",
        )
    )
    spread = classes.join(labels, ["label", "size"])
    keyed = stage(
        spread.filter(~F.col("whole"))
        .select("rep", "label", "embedding", "mean", F.col("needed").cast("int").alias("passes"))
        .mapInArrow(lambda b: _keys(b, bits, seed), "pass int, label long, key long, rep long, embedding array<double>"),
        "projection-keys",
    )
    parts = int(embeddings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ("pass", "label", "key", "rep")
    gather = lambda df: df.select(*order, "embedding").mapInArrow(lambda b: _windows(b, window, LOOSE), _LINKS)
    shown = stage(gather(keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)), "projection-links")
    # The rows at the partitions' borders, as many as partitions and windows make, meet once more.
    borders = shown.filter("a is null").dropDuplicates(order).repartition(1).sortWithinPartitions(*order)
    links = stage(
        shown.unionByName(gather(borders)).filter("a is not null").select("a", "b").distinct(), "projection-groups"
    )
    wholes = spread.filter("whole").select(F.col("rep").alias("node"), F.xxhash64("label", "size").alias("label"), F.lit(True).alias("whole"))
    comps = stage(components(links).select("node", "label", F.lit(False).alias("whole")).unionByName(wholes), "projection-components")

    grouped = comps.select(F.col("node").alias("rep"), F.xxhash64("label", "whole").alias("comp"))
    sizes = grouped.groupBy("comp").agg(F.count(F.lit(1)).alias("members"))
    members = (
        classes.select("rep", "weight", "embedding")
        .join(grouped, "rep")
        .join(sizes, "comp")
        .withColumn("blocks", F.ceil(F.col("members") / block).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    )
    # Each block meets every block of its group once, itself included.
    met = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "comp", "rep", "weight", "embedding",
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"),
        # Groups of one block share units, so that small ones are not handled one by one.
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("comp"), F.lit(_units(comps, parts))))
        .otherwise(F.xxhash64("comp", F.least("own", "other"), F.greatest("own", "other"))).alias("unit"),
    )
    met_once = stage(
        met.groupBy("unit").applyInArrow(lambda table: _count(table, cosine), "rep long, n long, root long"), "projection-counts"
    )
    counted = met_once.groupBy("rep").agg(F.sum("n").alias("n"))
    linked = stage(
        components(met_once.filter("rep <> root").select(F.least("rep", "root").alias("a"), F.greatest("rep", "root").alias("b")).distinct()),
        "projection-linked",
    )
    of_class = (
        classes.join(counted, "rep", "left")
        .join(linked.select(F.col("node").alias("rep"), F.col("label").alias("comp")), "rep", "left")
        .select(
            F.col("label").alias("c_label"),
            F.col("embedding").alias("c_embedding"),
            (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("comp", "rep").alias("component_id"),
        )
    )
    joined = valid.join(
        of_class, (F.col("label") == F.col("c_label")) & (F.col("embedding") == F.col("c_embedding"))
    ).select("vec_id", "n_links", "component_id")
    ok = usable("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rest = rows.filter(~ok).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _units(comps: DataFrame, parts: int) -> int:
    """Units of about 20,000 vectors for the components of one block."""
    return max(parts, math.ceil(comps.count() / 20_000))
