"""Whitening of embeddings, by an incremental eigendecomposition.

Entries become whole numbers, ``floor(1024 * c) + 100000``, so sums and deviations are exact. Each
task keeps the spectrum of the scatter of the vectors it has seen: a further vector is a rank-one
update along its deviation from their mean. The new eigenvalues are the roots of a secular
equation, one between every two old ones; eigenvalues that the vector does not touch, and all but
one of equal eigenvalues, are deflated and stay. Spectra of tasks are combined in a tree of ``FAN``
at a time, again by rank-one updates: one for each eigenvector of the other spectrum and one for the
distance of the means. The vectors found are then refined by Rayleigh and Ritz: one more pass sums
up, in each task, the covariance of exact deviations projected on all of them, and its
eigenvectors turn them into those of the whole covariance to double precision, however the rows
were dealt. A last pass measures how far the covariance of the whitened rows is from the identity.

A task holds one spectrum, D*D numbers for D dimensions, and so does the driver at the end. Work
is in proportion to the rows: a rank-one update costs D^3, which suits dimensions by the hundred.
Spectra are written to the shared scratch folder on each level, so a lost executor costs one level.

Defined results: rows whose vector is null, or holds null, NaN or infinite entries, or any of 2^40
and more (whose square has no exact place), are dropped. Of the other rows those with the most
frequent number of dimensions are kept, the larger number of equally frequent ones; vectors of
other lengths have no place in the same covariance. Repeated rows and rows without an id all count.
A component whose eigenvalue is zero to rounding has no whitened value (null) and is left out of
``identity_error``; ``explained`` is null if the whole variance is zero. ``deviation`` is null where
it does not fit a long. An empty table gives no rows; columns other than id and vector are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtally.llm.tables import materialised, table

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
# Spectra that one task combines.
FAN = 32
LARGEST = 2.0**40
_EPS = np.finfo(float).eps


# --- rank-one updates ---


def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + rho * sum(z2 / (d - x))``, for rising ``d``: one above each entry of ``d``.

    Returned with the differences ``d[j] - root[i]``, which are exact to rounding, since each root is
    sought as its distance from the nearer pole. Iterates on two poles and the slopes of both
    sides, and halves the interval wherever that leaves it.
    """
    k = len(d)
    right = np.append(d[1:], d[-1] + rho * z2.sum())
    columns = np.arange(k)
    middle = (d + right) / 2
    at_middle = 1 / rho + (z2[:, None] / (d[:, None] - middle)).sum(0)
    from_left = at_middle >= 0
    from_left[-1] = True
    origin = np.where(from_left, d, right)
    half = (right - d) / 2
    low = np.where(from_left, 0.0, -half)
    high = np.where(from_left, half, 0.0)
    high[-1] = right[-1] - d[-1]
    if at_middle[-1] < 0:
        low[-1] = half[-1]
    gaps = d[:, None] - origin
    below = columns[:, None] <= columns  # poles left of the root, in its column
    first, second = columns.copy(), columns + 1
    first[-1], second[-1] = k - 2, k - 1
    below[-1, -1] = False  # the last root has two poles on its left
    tau = (low + high) / 2
    for _ in range(100):
        apart = gaps - tau
        terms = z2[:, None] / apart
        slopes = terms / apart
        left, left_slope = np.where(below, terms, 0).sum(0), np.where(below, slopes, 0).sum(0)
        other, other_slope = terms.sum(0) - left, slopes.sum(0) - left_slope
        f = 1 / rho + left + other
        low, high = np.where(f < 0, tau, low), np.where(f < 0, high, tau)
        size = 1 / rho + np.abs(left) + np.abs(other) + np.abs(tau) * (left_slope + other_slope)
        done = (np.abs(f) <= 4 * _EPS * size) | (high - low <= 2 * _EPS * np.abs(tau))
        if done.all():
            break
        one, two = apart[first, columns], apart[second, columns]
        c = f - one * left_slope - two * other_slope
        a = (one + two) * f - one * two * (left_slope + other_slope)
        b = one * two * f
        root = np.sqrt(np.abs(a * a - 4 * b * c))
        with np.errstate(all="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step[-1] = (a[-1] + root[-1]) / (2 * c[-1]) if a[-1] >= 0 else 2 * b[-1] / (a[-1] - root[-1])
            newton = -f / (left_slope + other_slope)
        step = np.where(np.isfinite(step) & (step * f < 0), step, newton)
        ahead = tau + step
        inside = (ahead > low) & (ahead < high)
        tau = np.where(done, tau, np.where(inside, ahead, (low + high) / 2))
    apart = gaps - tau
    return origin + tau, apart


def rank_one(values: np.ndarray, vectors: np.ndarray, weight: float, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of ``vectors @ diag(values) @ vectors.T + weight * outer(v, v)``; ``values`` rise."""
    z = vectors.T @ v
    square = float(z @ z)
    rho = weight * square
    if not rho > 0:
        return values, vectors
    z /= np.sqrt(square)
    tolerance = 8 * _EPS * max(abs(values[-1]), abs(values[0]), rho)
    kept = np.flatnonzero(rho * np.abs(z) > tolerance)
    if not len(kept):
        return values, vectors
    # Of two equal eigenvalues one vector can be turned away from v.
    gap, s, c = np.diff(values[kept]), z[kept[:-1]], z[kept[1:]]
    if (gap * np.abs(s * c) <= tolerance * (s * s + c * c)).any():
        values, vectors, z, kept = _deflate(values.copy(), vectors.copy(), z, kept, tolerance)
    d, z = values[kept], z[kept]
    if len(kept) == 1:
        found, turned = d + rho * z * z, vectors[:, kept]
    else:
        found, apart = secular_roots(d, z * z, rho)
        # The vector whose secular equation has exactly these roots: its eigenvectors are
        # orthogonal, however close two roots are.
        k = len(d)
        poles = np.concatenate([d[1:], [0.0]])
        index = np.arange(k)
        under = np.where(index[:, None] > index, d, poles) - d[:, None]
        under[:, -1] = rho
        exact = np.sqrt(np.abs(np.prod(-apart / under, 1)))
        rotation = np.copysign(exact, z)[:, None] / apart
        rotation /= np.sqrt((rotation * rotation).sum(0))
        turned = vectors[:, kept] @ rotation
    values, vectors = values.copy(), vectors.copy()
    values[kept], vectors[:, kept] = found, turned
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


def _deflate(values, vectors, z, kept, tolerance):
    last, left = kept[0], []
    for j in kept[1:]:
        tau = np.hypot(z[last], z[j])
        c, s = z[j] / tau, -z[last] / tau
        if abs((values[j] - values[last]) * c * s) <= tolerance:
            z[last], z[j] = 0.0, tau
            one, two = vectors[:, last].copy(), vectors[:, j].copy()
            vectors[:, last], vectors[:, j] = c * one + s * two, c * two - s * one
            p, q = values[last], values[j]
            values[last], values[j] = p * c * c + q * s * s, p * s * s + q * c * c
        else:
            left.append(last)
        last = j
    left.append(last)
    return values, vectors, z, np.array(left)


class Spectrum:
    """Eigenvalues and vectors of the scatter of some integer vectors, their number and exact sums."""

    def __init__(self, dimensions: int):
        self.n, self.sums = 0, np.zeros(dimensions, np.int64)
        self.values, self.vectors = np.zeros(dimensions), np.eye(dimensions)

    def add(self, x: np.ndarray) -> None:
        if self.n:
            v = (self.n * x - self.sums) / self.n
            self.values, self.vectors = rank_one(self.values, self.vectors, self.n / (self.n + 1), v)
        self.n += 1
        self.sums += x

    def merge(self, other: Spectrum) -> None:
        if not self.n or not other.n:
            if other.n:
                self.n, self.sums, self.values, self.vectors = other.n, other.sums, other.values, other.vectors
            return
        for value, vector in zip(other.values, other.vectors.T):
            self.values, self.vectors = rank_one(self.values, self.vectors, value, vector)
        apart = other.sums / other.n - self.sums / self.n
        weight = self.n * (other.n / (self.n + other.n))
        self.values, self.vectors = rank_one(self.values, self.vectors, weight, apart)
        self.n += other.n
        self.sums = self.sums + other.sums


# --- over partitions ---


def _whole(batch: pa.RecordBatch, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors in whole numbers less ``SHIFT``, and the row of the batch each comes from."""
    lists = batch.column("vector")
    rows = np.flatnonzero(lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False) == dimensions)
    entries = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
    entries = entries.astype(float)
    fit = (np.abs(entries) < LARGEST).all(1)  # false for NaN, which is also what null becomes
    return np.floor(entries[fit] * SCALE).astype(np.int64), rows[fit]


_SPECTRUM = "n bigint, sums array<bigint>, values array<double>, vectors array<double>"
_SUM = "sums array<double>"


def _spectrum_batch(s: Spectrum) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(
        [{"n": s.n, "sums": s.sums.tolist(), "values": s.values.tolist(), "vectors": s.vectors.ravel().tolist()}],
        pa.schema([("n", pa.int64()), ("sums", pa.list_(pa.int64())), ("values", pa.list_(pa.float64())), ("vectors", pa.list_(pa.float64()))]),
    )


def _combined(
    parts: DataFrame, merge: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], name: str
) -> dict | None:
    """The rows of ``parts`` made one by ``merge``, ``FAN`` at a time; None if there are none."""
    parts = materialised(parts, name)
    count = parts.count()
    while count > 1:
        count = -(-count // FAN)
        parts = materialised(parts.repartition(count).mapInArrow(merge, parts.schema), name)
    row = parts.first()
    return row.asDict() if row else None


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for sums in batch.column("sums"):
            values = np.array(sums.as_py())
            total = values if total is None else total + values
    if total is not None:
        yield _sum_batch(total)


def _sum_batch(total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"sums": total.ravel().tolist()}], pa.schema([("sums", pa.list_(pa.float64()))]))


@dataclass(frozen=True)
class Whitening:
    """``n`` fitted vectors with the exact ``sums`` of their entries, all components by falling
    eigenvalue as columns, the eigenvalues, and the measured distance from the identity."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    identity_error: float = 0.0

    @property
    def trace(self) -> float:
        return float(self.values.sum())

    def usable(self, k: int) -> np.ndarray:
        """Which of the first ``k`` components have any variance."""
        return self.values[:k] > len(self.values) * _EPS * max(self.trace, 0.0)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``x - mean`` in double precision, from the exact difference."""
        whole, rest = np.divmod(self.sums, self.n)
        return (x - whole) - rest / self.n

    def whiten(self, x: np.ndarray, k: int) -> np.ndarray:
        fit = self.usable(k)
        out = np.full((len(x), len(fit)), np.nan)
        out[:, fit] = self.deviations(x) @ self.components[:, :k][:, fit] / np.sqrt(self.values[:k][fit])
        return out

    def exact_deviation(self, x: np.ndarray) -> pa.Array:
        """Sum of (n * x - sums)^2 of each row, null where it does not fit a long."""
        size = ((self.deviations(x) * self.n) ** 2).sum(1)
        fits = size < 2.0**62
        apart = np.where(fits[:, None], self.n * x - self.sums, 0)
        return pa.array((apart * apart).sum(1), pa.int64(), mask=~fits)


def _vectors(df: DataFrame, column: str, *others: str) -> DataFrame:
    return df.select(*others, F.col(column).cast("array<double>").alias("vector"))


def _dimensions(vectors: DataFrame) -> int | None:
    fit = F.forall("vector", lambda e: F.coalesce(F.abs(e) < LARGEST, F.lit(False)))
    sizes = vectors.where(F.col("vector").isNotNull() & fit).groupBy(F.size("vector").alias("size")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return most["size"] if most else None


def fit_whitening(df: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all usable vectors in ``column``; None if there are none."""
    vectors = _vectors(df, column)
    size = _dimensions(vectors)
    if not size:
        return None

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spectrum = Spectrum(size)
        for batch in batches:
            for x in _whole(batch, size)[0]:
                spectrum.add(x)
        if spectrum.n:
            yield _spectrum_batch(spectrum)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = Spectrum(size)
        for batch in batches:
            for row in batch.to_pylist():
                one = Spectrum(size)
                one.n, one.sums = row["n"], np.array(row["sums"], np.int64)
                one.values, one.vectors = np.array(row["values"]), np.array(row["vectors"]).reshape(size, size)
                whole.merge(one)
        if whole.n:
            yield _spectrum_batch(whole)

    first = _combined(vectors.mapInArrow(fold, _SPECTRUM), merge, "spectra")
    basis = np.linalg.qr(np.array(first["vectors"]).reshape(size, size)[:, ::-1])[0]
    found = Whitening(first["n"], np.array(first["sums"], np.int64), basis, np.ones(size))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            y = found.deviations(_whole(batch, size)[0]) @ basis
            total += y.T @ y
        yield _sum_batch(total)

    ritz = _combined(vectors.mapInArrow(project, _SUM), _sum_rows, "ritz")
    inner = np.array(ritz["sums"]).reshape(size, size) / found.n
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    found = Whitening(found.n, found.sums, basis @ turn[:, ::-1], values[::-1].copy())
    fit = found.usable(components)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 + fit.sum(), fit.sum()))
        for batch in batches:
            w = found.whiten(_whole(batch, size)[0], components)[:, fit]
            total[0] += w.sum(0)
            total[1:] += w.T @ w
        yield _sum_batch(total)

    error = 0.0
    if fit.any():
        sums = _combined(vectors.mapInArrow(measure, _SUM), _sum_rows, "identity")
        total = np.array(sums["sums"]).reshape(1 + fit.sum(), fit.sum()) / found.n
        error = np.abs(total[1:] - np.outer(total[0], total[0]) - np.eye(fit.sum())).max()
    return Whitening(found.n, found.sums, found.components, found.values, float(error))


_RESULT = (
    "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def whitened(
    df: DataFrame, model: Whitening | None, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """A row for each usable row of ``df`` and component up to ``components``, with its ``key``."""
    rows = _vectors(df, column, F.col(key).cast("bigint").alias(key))
    schema = f"{key} bigint, {_RESULT}"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    size = len(model.values)
    k = min(components, size)
    shares = model.values[:k] / model.trace if model.trace > 0 else np.full(k, np.nan)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, row = _whole(batch, size)
            if len(x):
                times = np.repeat(np.arange(len(x)), k)
                values = model.whiten(x, k).ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(key).take(pa.array(row[times])),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(times), model.n)),
                        model.exact_deviation(x).take(pa.array(times)),
                        pa.array(values, mask=np.isnan(values)),
                        pa.array(np.tile(shares, len(x)), mask=np.tile(np.isnan(shares), len(x))),
                        pa.array(np.full(len(times), model.identity_error)),
                    ],
                    [c.split()[0] for c in schema.split(", ")],
                )

    return rows.mapInArrow(emit, schema)


def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return whitened(vectors, fit_whitening(vectors))
