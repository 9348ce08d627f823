"""Toxicity by a classifier chain: linear models for categories in turn, each given the earlier
ones' probabilities, trained on out-of-fold predictions of them.

Features are the presence of lower-case words and of their first four and five letters, hashed;
the ones that tell toxic from clean best are kept. The categories are words of the label: a
toxic document belongs to a category if it has one of the category's seed words. The last link
is the label itself. Training takes a bounded sample of the labelled rows; every document is
scored whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from meterloom.llm.common import bounded_batches, stage

#: Labelled documents that training takes at most (by a hash of their id).
SAMPLE = 20_000
#: Hashed features, and how many of them the models keep.
HASHED, KEPT = 1 << 20, 2000
FOLDS = 5
SEEDS = {
    "insult": ("idiot", "moron", "stupid", "clown", "loser", "fool"),
    "contempt": ("worthless", "pathetic", "scum", "trash", "disgusting", "vermin"),
}
THRESHOLD = 0.5
_EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")
REMEMBERED = 150_000


class _Features(dict):
    """Feature numbers of a token as it stands in the text."""

    def __init__(self, wanted: dict[int, int] | None = None):
        self.wanted = wanted

    def __missing__(self, token: str) -> tuple[int, ...]:
        if len(self) > REMEMBERED:
            self.clear()
        word = _EDGES.sub("", token.lower())
        parts = [word] if word else []
        parts += [f"^{word[:k]}" for k in (4, 5) if len(word) > k]
        found = [xxhash.xxh32_intdigest(p.encode("utf-8", "surrogatepass")) % HASHED for p in parts]
        if self.wanted is not None:
            found = [self.wanted[f] for f in found if f in self.wanted]
        value = self[token] = tuple(found)
        return value

    def of(self, text: str | None) -> list[int]:
        out: set[int] = set()
        for token in set(text.split()) if text else ():
            out.update(self[token])
        return sorted(out)


def _training_rows(batches, seeds: dict[str, tuple[str, ...]]) -> Iterator[pa.RecordBatch]:
    features = _Features()
    for batch in batches:
        feats, cats = [], []
        for text, toxic in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            feats.append(features.of(text))
            words = {_EDGES.sub("", t) for t in set(text.lower().split())} if text else set()
            cats.append([int(bool(toxic) and not words.isdisjoint(s)) for s in seeds.values()] + [int(bool(toxic))])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(feats, pa.list_(pa.int32())), pa.array(cats, pa.list_(pa.int32()))],
            names=["doc_id", "features", "labels"],
        )


class _Rows:
    """Sparse 0/1 rows plus a few dense columns."""

    def __init__(self, row: np.ndarray, col: np.ndarray, n: int, width: int):
        self.row, self.col, self.n, self.width = row, col, n, width

    def times(self, w: np.ndarray, dense: np.ndarray) -> np.ndarray:
        k = dense.shape[1]
        return (
            np.bincount(self.row, w[self.col], self.n) + dense @ w[self.width : self.width + k] + w[-1]
        )

    def back(self, r: np.ndarray, dense: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(self.col, r[self.row], self.width), dense.T @ r, [r.sum()]])


def _fit(x: _Rows, dense: np.ndarray, y: np.ndarray, use: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Logistic regression with a small ridge, by Adam on the rows in ``use``."""
    w = np.zeros(x.width + dense.shape[1] + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    n = max(use.sum(), 1)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x.times(w, dense), -30, 30)))
        g = x.back((p - y) * use / n, dense) + 1e-5 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.25 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return w


def _link(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-3, 1 - 1e-3)
    return np.log(p / (1 - p))


def _chosen(features: DataFrame, kept: int) -> np.ndarray:
    """The at most ``kept`` features that tell toxic from clean best, sorted. Counted by Spark over
    all training rows; only the chosen ones reach the driver."""
    toxic = F.element_at("labels", -1)
    share = features.agg(F.avg(toxic)).first()[0]
    if not share:
        return np.empty(0, np.int64)
    counted = (
        features.select(F.explode("features").alias("feature"), toxic.alias("toxic"))
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("pos"))
        .withColumn("expected", F.col("n") * F.lit(share))
    )
    counted = stage(
        counted.select("feature", "n", (F.pow(F.col("pos") - F.col("expected"), 2) / (F.col("expected") + 1)).alias("gain")),
        "toxicity-gains",
    )
    # The more features there are, the more of them stand out by chance.
    bound = 2 * np.log(max(counted.count(), 1))
    best = counted.filter(f"n >= 3 AND gain > {float(bound)!r}D").orderBy(F.desc("gain"), "feature").limit(kept)
    return np.sort(best.select("feature").toPandas()["feature"].to_numpy(np.int64))


def _narrow(batches, chosen: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Training rows with the chosen features only, as places among them."""
    for batch in batches:
        features = batch.column(1)
        flat = np.asarray(features.flatten())
        inside = np.isin(flat, chosen)
        ends = np.concatenate([[0], np.cumsum(inside)])[np.asarray(features.offsets) - features.offsets[0].as_py()]
        places = pa.array(np.searchsorted(chosen, flat[inside]).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), places), batch.column(2)],
            names=["doc_id", "features", "labels"],
        )


def _train(batches, chosen: np.ndarray, folds: int) -> Iterator[pa.RecordBatch]:
    """One row per link and feature (a feature, -1 the intercept, -2 - j earlier link j)."""
    held = list(batches)
    table = pa.Table.from_batches(held) if held else None
    out: list[tuple[int, int, float]] = []
    if table is not None and len(table):
        table = table.sort_by("doc_id").combine_chunks()
        features = table.column("features").combine_chunks()
        labels = np.array(table.column("labels").to_pylist(), float)
        n = len(table)
        row = np.repeat(np.arange(n), np.diff(np.asarray(features.offsets)))
        x = _Rows(row, np.asarray(features.flatten()).astype(np.int64), n, len(chosen))
        fold = np.array([xxhash.xxh32_intdigest(str(i)) % folds for i in table.column("doc_id").to_pylist()])
        dense = np.empty((n, 0))
        for k in range(labels.shape[1]):
            y = labels[:, k]
            if 0 < y.sum() < len(y):
                w = _fit(x, dense, y, np.ones(len(y)))
                guess = np.empty(len(y))
                for f in range(folds):
                    held = fold == f
                    if held.any():
                        part = _fit(x, dense, y, (~held).astype(float))
                        guess[held] = 1 / (1 + np.exp(-np.clip(x.times(part, dense), -30, 30)))[held]
            else:  # a label without two sides is not learned: its share stands for all
                w = np.zeros(x.width + dense.shape[1] + 1)
                w[-1] = _link(y.mean(keepdims=True))[0]
                guess = np.full(len(y), y.mean())
            out += [(k, int(c), float(v)) for c, v in zip(chosen, w[: x.width], strict=True)]
            out += [(k, -2 - j, float(v)) for j, v in enumerate(w[x.width : -1])]
            out.append((k, -1, float(w[-1])))
            dense = np.column_stack([dense, _link(guess)])
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int32()), pa.array([r[2] for r in out], pa.float64())],
        names=["link", "feature", "weight"],
    )


def train(
    docs: DataFrame,
    labels: DataFrame,
    seeds: dict[str, tuple[str, ...]] = SEEDS,
    sample: int = SAMPLE,
    kept: int = KEPT,
    folds: int = FOLDS,
) -> DataFrame:
    """The chain as a table: ``link``, ``feature``, ``weight``. ``labels`` has ``doc_id`` and
    ``toxic``; of at most ``sample`` labelled documents, taken by a hash of the id. A document
    labelled twice is toxic if one label says so; null labels and ids are left out."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(chosen), "doc_id"
    )
    columns = "doc_id long, features array<int>, labels array<int>"
    features = stage(
        rows.select("doc_id", "text", "toxic").mapInArrow(lambda b: _training_rows(b, seeds), columns), "toxicity-training"
    )
    best = _chosen(features, kept)
    return (
        features.mapInArrow(lambda b: _narrow(b, best), columns)
        .repartition(1)
        .mapInArrow(lambda b: _train(b, best, folds), "link int, feature int, weight double")
    )


def _score(batches, chain, place: int) -> Iterator[pa.RecordBatch]:
    """Every column as it is, then the chain's probabilities."""
    wanted, weights, earlier, intercepts = chain.value
    features = _Features(wanted)
    for batch in batches:
        found = [features.of(t.as_py()) for t in batch.column(place)]
        row = np.repeat(np.arange(len(found)), [len(f) for f in found])
        col = np.array([f for fs in found for f in fs], np.int64)
        probabilities: list[np.ndarray] = []
        for k, b in enumerate(intercepts):
            s = np.bincount(row, weights[k][col], len(found)) + b
            for j, w in enumerate(earlier[k]):
                s = s + w * _link(probabilities[j])
            probabilities.append(1 / (1 + np.exp(-np.clip(s, -30, 30))))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *[pa.array(np.round(p, 6)) for p in probabilities]],
            names=[*batch.schema.names, *[f"_p{k}" for k in range(len(probabilities))]],
        )


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    seeds: dict[str, tuple[str, ...]] = SEEDS,
    **training,
) -> DataFrame:
    """``docs`` with a probability per category (``p_<category>``), ``p_toxic``, and
    ``is_toxic``: whether ``p_toxic`` reaches ``threshold``. One row per row of ``docs``.

    Null and empty texts have no features and get the intercept's probability. Repeated rows
    score alike. Without labels of both kinds every document gets the labels' share (0 without
    any). Other columns keep their values; of the added names, those that ``docs`` already has
    are replaced. No rows, no rows.
    """
    bounded_batches(docs.sparkSession)
    names = [*seeds, "toxic"]
    added = [f"p_{n}" for n in names]
    docs = docs.drop(*added, "is_toxic", *[f"_p{k}" for k in range(len(names))])
    model = train(docs, labels, seeds, **training).toPandas()
    chosen = sorted(int(f) for f in model.loc[model.feature >= 0, "feature"].unique())
    wanted = {f: i for i, f in enumerate(chosen)}
    weights, earlier, intercepts = [], [], []
    for k in range(len(names)):
        part = model[model.link == k]
        w = np.zeros(max(len(chosen), 1))
        own = part[part.feature >= 0]
        w[[wanted[int(f)] for f in own.feature]] = own.weight.to_numpy()
        weights.append(w)
        earlier.append(part[part.feature <= -2].sort_values("feature", ascending=False).weight.tolist())
        intercepts.append(float(part.loc[part.feature == -1, "weight"].sum()) if len(part) else -30.0)
    chain = docs.sparkSession.sparkContext.broadcast((wanted, weights, earlier, intercepts))
    schema = StructType([*docs.schema, *[StructField(f"_p{k}", DoubleType()) for k in range(len(names))]])
    place = docs.columns.index("text")
    scored = docs.mapInArrow(lambda b: _score(b, chain, place), schema)
    return scored.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        *[F.col(f"_p{k}").alias(n) for k, n in enumerate(added)],
        (F.col(f"_p{len(names) - 1}") >= threshold).alias("is_toxic"),
    )
