"""Whitening of embeddings by an incremental eigendecomposition.

Vectors become whole numbers first, so counts, sums and deviations are exact. Every partition
keeps the spectrum of what it has seen: count, mean, eigenvalues and eigenvectors of the centred
scatter. New rows enter as rank-one updates. Each update solves the secular equation between
neighbouring eigenvalues, after deflation of the directions that it does not touch and of equal
eigenvalues, and builds eigenvectors from the solutions (from weights recomputed from them, which
keeps the vectors orthogonal). A block of rows is first turned by a QR factorisation into at most
as many rows as there are dimensions, with the same scatter; its mean enters by one more update.
Spectra are combined in the same way, one update for each eigenvector of the other spectrum and one
for the difference of the means, sixteen at a time until one is left.

Rounding adds up over updates, so a last distributed pass projects all vectors onto the basis found
and solves the projected problem (Rayleigh-Ritz). The basis is complete, hence the result is that
of the covariance to double precision. What reaches the driver or is sent to tasks is one matrix
of the vectors' dimension.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import bounded_batches, stage

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
#: Rows that become one block of updates, and tables that one task combines.
BLOCK, FAN_IN = 2048, 16
EPS = np.finfo(np.float64).eps
#: Beyond this a scaled entry is not told apart from its neighbours as a double.
LARGEST = float(1 << 52)


def secular_roots(d: np.ndarray, z: np.ndarray, steps: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(z**2 / (d - x)), one above each d (ascending, all apart, z not 0).

    Returns for every root the pole nearest to it and its distance from that pole, so that the
    distances to all poles can be formed without cancellation. Each step models the poles below
    and above by one pole each and falls back to halving the bracket where that leads out of it.
    """
    n, z2 = len(d), z * z
    upper = np.append(d[1:], d[-1] + z2.sum())
    middle = (d + upper) / 2
    at_middle = 1 + (z2 / (d - middle[:, None])).sum(1)
    left = at_middle >= 0  # the root is in the lower half
    left[-1] = True
    origin = np.where(left, np.arange(n), np.minimum(np.arange(n) + 1, n - 1))
    gaps = d[None, :] - d[origin][:, None]
    half = (upper - d) / 2
    low = np.where(left, 0.0, -half)
    high = np.where(left, half, 0.0)
    if at_middle[-1] < 0:
        low[-1], high[-1] = half[-1], 2 * half[-1]
    else:
        high[-1] = half[-1]
    x = (low + high) / 2
    below = np.tril(np.ones((n, n), bool))
    next_pole = np.append(gaps[np.arange(n - 1), np.arange(1, n)], np.inf)
    own_pole = gaps[np.arange(n), np.arange(n)]
    for _ in range(steps):
        distance = gaps - x[:, None]
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            terms = z2 / distance
            slopes = terms / distance
            psi, phi = np.where(below, terms, 0).sum(1), np.where(below, 0, terms).sum(1)
            dpsi, dphi = np.where(below, slopes, 0).sum(1), np.where(below, 0, slopes).sum(1)
            f = 1 + psi + phi
            high = np.where(f > 0, np.minimum(high, x), high)
            low = np.where(f < 0, np.maximum(low, x), low)
            # 1 + (p + q / (own - t)) + (r + s / (next - t)) = 0, a quadratic in t
            own, following = own_pole - x, next_pole - x
            q = dpsi * own**2
            s = np.where(np.isfinite(following), dphi * following**2, 0.0)
            c = 1 + (psi - dpsi * own) + np.where(np.isfinite(following), phi - dphi * following, 0.0)
            ends = np.where(np.isfinite(next_pole), next_pole, 0.0)
            a2, a1, a0 = c, -(c * (own_pole + ends) + q + s), c * own_pole * ends + q * ends + s * own_pole
            root = np.sqrt(np.maximum(a1 * a1 - 4 * a2 * a0, 0.0))
            pivot = -(a1 + np.where(a1 >= 0, root, -root)) / 2
            first, second = a0 / pivot, pivot / a2
            single = own_pole + q / c
        inside = lambda t: np.isfinite(t) & (t > low) & (t < high)
        last = ~np.isfinite(next_pole)
        new = np.where(last & inside(single), single, np.where(~last & inside(first), first, np.where(~last & inside(second), second, (low + high) / 2)))
        done = (f == 0) | (np.abs(new - x) <= 2 * EPS * np.abs(x)) | (np.abs(f) <= 4 * EPS * (1 + np.abs(psi) + np.abs(phi)))
        x = np.where(done, x, new)
        if done.all():
            break
    return origin, x


def rank_one(values: np.ndarray, basis: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors of ``basis diag(values) basis' + v v'``."""
    z = basis.T @ v
    weight = float(z @ z)
    if weight == 0.0:
        return values, basis
    values, basis = values.copy(), basis.copy()
    tolerance = 8 * EPS * max(float(np.abs(values).max()), weight)
    # Deflation: of two equal eigenvalues one direction can be turned out of the update.
    kept: list[int] = []
    for i in np.flatnonzero(np.abs(z) * np.sqrt(weight) > tolerance):
        if kept:
            j = kept[-1]
            r = np.hypot(z[i], z[j])
            c, s = z[i] / r, z[j] / r
            if abs((values[i] - values[j]) * c * s) <= tolerance:
                basis[:, [j, i]] = basis[:, [j, i]] @ np.array([[c, s], [-s, c]])
                values[j], values[i] = c * c * values[j] + s * s * values[i], s * s * values[j] + c * c * values[i]
                z[i], z[j] = r, 0.0
                kept[-1] = i
                continue
        kept.append(i)
    if not kept:
        return values, basis
    k = np.array(kept)
    k = k[np.argsort(values[k], kind="stable")]
    d, zk = values[k], z[k]
    origin, x = secular_roots(d, zk)
    # distance[i, j] = d[j] - root[i], free of cancellation
    distance = (d[None, :] - d[origin][:, None]) - x[:, None]
    apart = d[None, :] - d[:, None]
    np.fill_diagonal(apart, 1.0)
    n = len(k)
    ratio = -distance.copy()
    # weights for which the roots found are exact: prod(root - d_j) / prod(d_i - d_j)
    weights = np.empty(n)
    for j in range(n):
        numerator = np.append(ratio[:j, j] / -apart[j, :j], ratio[j : n - 1, j] / apart[j, j + 1 :])
        weights[j] = np.abs(ratio[n - 1, j] * numerator.prod())
    z_hat = np.copysign(np.sqrt(weights), zk)
    turn = z_hat[None, :] / distance
    turn /= np.linalg.norm(turn, axis=1)[:, None]
    basis[:, k] = basis[:, k] @ turn.T
    values[k] = d[origin] + x
    order = np.argsort(values, kind="stable")
    return values[order], basis[:, order]


class Spectrum:
    """Count, mean, and the eigenvalues and eigenvectors of the centred scatter of the rows seen."""

    def __init__(self, dims: int, n: int = 0, mean=None, values=None, basis=None):
        self.n = n
        self.mean = np.zeros(dims) if mean is None else np.array(mean, np.float64)
        self.values = np.zeros(dims) if values is None else np.array(values, np.float64)
        self.basis = np.eye(dims) if basis is None else np.array(basis, np.float64).reshape(dims, dims)

    def update(self, v: np.ndarray) -> None:
        self.values, self.basis = rank_one(self.values, self.basis, v)

    def _shift(self, n: int, mean: np.ndarray) -> None:
        """Room for ``n`` more rows of the given mean, whose own scatter has been added."""
        if self.n:
            self.update((mean - self.mean) * np.sqrt(self.n * n / (self.n + n)))
        self.mean = self.mean + (mean - self.mean) * (n / (self.n + n))
        self.n += n

    def add(self, rows: np.ndarray) -> None:
        mean = rows.mean(0)
        for v in np.linalg.qr(rows - mean, mode="r"):
            self.update(v)
        self._shift(len(rows), mean)

    def join(self, other: Spectrum) -> None:
        for value, vector in zip(other.values, other.basis.T, strict=True):
            if value > 0:
                self.update(vector * np.sqrt(value))
        self._shift(other.n, other.mean)


def _whole(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors' whole numbers (without the shift)."""
    flat = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


_SPECTRUM = "n long, sums array<decimal(38,0)>, mean array<double>, values array<double>, basis array<double>"


def _spectrum_row(n: int, sums: list[int], s: Spectrum) -> pa.RecordBatch:
    import decimal

    return pa.RecordBatch.from_arrays(
        [
            pa.array([n], pa.int64()),
            pa.array([[decimal.Decimal(x) for x in sums]], pa.list_(pa.decimal128(38, 0))),
            *[pa.array([x.ravel().tolist()], pa.list_(pa.float64())) for x in (s.mean, s.values, s.basis)],
        ],
        names=["n", "sums", "mean", "values", "basis"],
    )


def _spectra(batches: Iterator[pa.RecordBatch], dims: int, block: int) -> Iterator[pa.RecordBatch]:
    """One row: the spectrum of the partition."""
    seen, sums, n = Spectrum(dims), [0] * dims, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        whole = _whole(batch)
        for start in range(0, len(whole), block):
            rows = whole[start : start + block]
            sums = [a + b for a, b in zip(sums, rows.sum(0).tolist(), strict=True)]  # a block's sums fit 64 bits
            n += len(rows)
            seen.add(rows.astype(np.float64))
    if n:
        yield _spectrum_row(n, sums, seen)


def _join_spectra(table: pa.Table, dims: int) -> pa.Table:
    total, sums, n = Spectrum(dims), [0] * dims, 0
    for row in table.sort_by("id").to_pylist():
        total.join(Spectrum(dims, row["n"], row["mean"], row["values"], row["basis"]))
        sums = [a + int(b) for a, b in zip(sums, row["sums"], strict=True)]
        n += row["n"]
    return pa.Table.from_batches([_spectrum_row(n, sums, total)])


def _add_up(table: pa.Table) -> pa.Table:
    lists = [np.asarray(row, np.float64) for row in table.column("sums").to_pylist()]
    return pa.table({"sums": pa.array([np.sum(lists, 0).tolist()], pa.list_(pa.float64()))})


def _to_one(parts: DataFrame, combine: Callable[[pa.Table], pa.Table], schema: str, label: str):
    """The rows of ``parts`` combined, some at a time, until one is left; it, or None if there are none."""
    parts = stage(parts, label)
    while (n := parts.count()) > 1:
        numbered = stage(parts.withColumn("id", F.monotonically_increasing_id()), label)
        key = F.pmod(F.xxhash64("id"), F.lit(-(-n // FAN_IN)))
        parts = stage(numbered.groupBy(key.alias("part")).applyInArrow(combine, schema), label)
    return parts.first()


def _products(batches: Iterator[pa.RecordBatch], project: Callable[[np.ndarray], np.ndarray], size: int) -> Iterator[pa.RecordBatch]:
    """One row: sums of the products of all pairs of projected entries, then sums of the entries."""
    squares, sums, some = np.zeros((size, size)), np.zeros(size), False
    for batch in batches:
        if batch.num_rows:
            y = project(_whole(batch))
            squares, sums, some = squares + y.T @ y, sums + y.sum(0), True
    if some:
        yield pa.RecordBatch.from_arrays(
            [pa.array([np.concatenate([squares.ravel(), sums]).tolist()], pa.list_(pa.float64()))], names=["sums"]
        )


def _deviations(whole: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums over dimensions of (n x - S)**2; null where beyond 64 bits."""
    reach = n * float(np.abs(whole).max(initial=0)) + max(map(abs, map(float, sums)), default=0.0)
    if reach**2 * max(1, whole.shape[1]) < 2.0**62:
        return ((whole * n - np.array(sums, np.int64)) ** 2).sum(1).tolist()
    exact = ((whole.astype(object) * n - np.array(sums, object)) ** 2).sum(1)
    return [int(x) if x < 1 << 63 else None for x in exact]


def whiten(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    shift: int = SHIFT,
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector: the id, ``n``, ``deviation``, ``whitened`` and ``explained`` (arrays, a
    place for each component by falling eigenvalue) and ``identity_error``.

    Entries c become x = floor(scale c) + shift; covariance is that of x over all vectors kept,
    divisor ``n``. ``deviation`` is the sum of (n x - S)**2 over dimensions, S their sums, and null
    where 64 bits do not hold it. ``identity_error`` is the largest entry of the covariance of
    ``whitened``, measured over all rows, minus the identity.

    Left out: vectors that are null, empty, or hold null, non-finite or such large entries that a
    double does not hold them as whole numbers; and vectors of another length than most (of equally
    frequent lengths, the smaller stays). Directions without variance are no components, so there
    may be fewer, and equal vectors, or a single one, have none. Rows without an id and repeated
    rows are vectors like others. Other columns are ignored. An empty table gives no rows.
    ``block=1`` updates row by row.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    c = F.col(f"`{vector_col}`").cast("array<double>")
    fine = F.forall(c, lambda x: F.coalesce(F.abs(x) * scale < LARGEST, F.lit(False)) & ~F.isnan(F.coalesce(x, F.lit(0.0))))
    usable = vectors.filter(c.isNotNull() & (F.size(c) > 0) & fine)
    # floor(scale c) without the shift: it moves no difference, and keeps the numbers small.
    rows = stage(usable.select(F.col(f"`{id_col}`").alias("id"), F.transform(c, lambda x: F.floor(x * scale)).alias("x")), "whitening-rows")
    empty = "id long, n long, deviation long, whitened array<double>"
    common = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    if common is None:
        nothing = spark.createDataFrame([], empty).withColumns({"explained": F.array().cast("array<double>"), "identity_error": F.lit(0.0)})
        return nothing.withColumnRenamed("id", id_col)
    dims = common["dims"]
    rows = rows.filter(F.size("x") == dims)
    numbers = rows.select("x")

    found = _to_one(
        numbers.mapInArrow(lambda b: _spectra(b, dims, block), _SPECTRUM), lambda t: _join_spectra(t, dims), _SPECTRUM, "whitening-spectra"
    )
    n, sums = found["n"], [int(s) for s in found["sums"]]
    centre = np.array([s / n for s in sums])
    basis = np.linalg.qr(np.array(found["basis"]).reshape(dims, dims))[0]
    ritz = _to_one(
        numbers.mapInArrow(lambda b: _products(b, lambda x: (x - centre) @ basis, dims), "sums array<double>"), _add_up, "sums array<double>", "whitening-ritz"
    )
    squares, means = np.array(ritz["sums"][: dims * dims]).reshape(dims, dims) / n, np.array(ritz["sums"][dims * dims :]) / n
    values, inner = np.linalg.eigh(squares - np.outer(means, means))
    values, turned = values[::-1], (basis @ inner)[:, ::-1]
    k = min(components, int((values > 16 * dims * EPS * max(values[0], 0.0)).sum()))
    turned = turned[:, :k] / np.sqrt(values[:k])
    explained = (values[:k] / values.sum()).tolist() if k else []

    whitened = lambda x: (x - centre) @ turned
    check = _to_one(numbers.mapInArrow(lambda b: _products(b, whitened, k), "sums array<double>"), _add_up, "sums array<double>", "whitening-check")
    squares, means = np.array(check["sums"][: k * k]).reshape(k, k) / n, np.array(check["sums"][k * k :]) / n
    error = float(np.abs(squares - np.outer(means, means) - np.eye(k)).max(initial=0.0))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = _whole(batch)
            flat = pa.array(whitened(whole).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(whole) + 1, dtype=np.int32) * k), flat)
            count = pa.array(np.full(len(whole), n))
            yield pa.RecordBatch.from_arrays([batch.column(0), count, pa.array(_deviations(whole, n, sums), pa.int64()), lists], names=["id", "n", "deviation", "whitened"])

    out = rows.withColumn("id", F.col("id").cast("long")).mapInArrow(project, empty)
    return out.withColumns(
        {"explained": F.array(*map(F.lit, explained)).cast("array<double>"), "identity_error": F.lit(error)}
    ).withColumnRenamed("id", id_col)
