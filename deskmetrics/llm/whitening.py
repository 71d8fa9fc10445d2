"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

Vectors are read as integers, floor(256 * c), which saturate at the ends of a
long.  The model is fitted on each distinct integer vector once: exact sums,
then the centred scatter, added up per partition and over partitions.  The
scatter (dimension squared, whatever the number of rows) goes to the driver:
pivoted Cholesky gives a triangular factor, one-sided Jacobi rotates its
columns until they are orthogonal, their norms give the eigenvalues and the
normalised columns the components.

Defined results: a row whose vector is NULL or holds NULL or non-finite
entries is left out; vectors of several lengths: the length of most distinct
vectors (the greater on a tie) counts, rows of other lengths are left out;
repeated vectors count once in the fit and are all returned; NULL ids and
other columns pass through, those with the names of added ones are replaced;
a component without variance (one distinct vector, or fewer than dimensions)
has a NULL ``whitened`` and ``explained`` 0, or NULL if there is no variance
at all; an empty table gives an empty result.  ``deviation`` is NULL where it
has more than 38 digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import drop_staged, fresh, staged, undotted, without

LEVELS = 256
WIDE = 1 << 62      # sums below this are added as longs, others as Python's integers
ADDED = ("n bigint, deviation decimal(38,0), whitened array<double>, explained array<double>, "
         "identity_error double")


def integers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows with a whole finite vector, their lengths, all their entries as longs)."""
    column = column.cast(pa.large_list(pa.float64()))
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    entries = column.flatten()
    row = np.repeat(np.arange(len(column)), lengths)
    value = entries.to_numpy(zero_copy_only=False)      # NULL becomes NaN
    whole = column.is_valid().to_numpy(zero_copy_only=False).copy()
    whole[row[~np.isfinite(value)]] = False
    scaled = np.floor(LEVELS * value[whole[row]])
    x = np.clip(scaled, -2.0**63, 2.0**62).astype(np.int64)
    large = scaled >= 2.0**62
    x[large] = np.where(scaled[large] >= 2.0**63, np.iinfo(np.int64).max,
                        np.minimum(scaled[large], 2.0**63 - 1024).astype(np.int64))
    return np.flatnonzero(whole), lengths[whole], x


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column(0).flatten().to_numpy().reshape(-1, dim)


def _top(x: np.ndarray) -> int:
    """The greatest absolute value (of longs, the least one included)."""
    return max(int(x.max()), -int(x.min())) if x.size else 0


@dataclass(frozen=True)
class Whitening:
    n: int                     # distinct vectors of the fit
    sums: tuple[int, ...]      # exact, per dimension
    values: np.ndarray         # eigenvalues by falling size
    vectors: np.ndarray        # components as columns
    trace: float
    identity_error: float | None = None

    @property
    def dim(self) -> int:
        return len(self.sums)

    def explained(self, k: int) -> list[float | None]:
        return [float(v / self.trace) if self.trace > 0 else None for v in self.values[:k]]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x minus the means; the whole parts are subtracted exactly."""
        whole = np.array([s // self.n for s in self.sums], object)
        part = np.array([s % self.n / self.n for s in self.sums])
        if _top(x) + max(map(abs, whole), default=0) < WIDE:
            return (x - whole.astype(np.int64)) - part
        return (x.astype(object) - whole).astype(float) - part

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum of (n * x - sums) squared over the dimensions, exact."""
        whole = np.array([s // self.n for s in self.sums], object)
        rest = np.array([s % self.n for s in self.sums], object)
        most = self.n * (_top(x) + max(map(abs, whole), default=0) + 1)
        if most * most * max(self.dim, 1) < WIDE:
            off = self.n * (x - whole.astype(np.int64)) - rest.astype(np.int64)
            return (off * off).sum(1).tolist()
        off = self.n * (x.astype(object) - whole) - rest
        return (off * off).sum(1).tolist()

    def project(self, x: np.ndarray, k: int) -> np.ndarray:
        """The first k whitened coordinates; NaN where a component has no variance."""
        scale = np.array([v ** -0.5 if v > 0 else np.nan for v in self.values[:k]])
        return self.centred(x) @ self.vectors[:, :k] * scale


def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order) with v[order][:, order] = L L'; L is lower trapezoidal, its
    columns as many as the rank."""
    d = len(v)
    order, left = np.arange(d), v.diagonal().astype(float).copy()
    factor = np.zeros((d, d))
    least = d * np.finfo(float).eps * left.max(initial=0)
    for k in range(d):
        at = k + int(np.argmax(left[k:]))
        if left[at] <= least:
            return factor[:, :k], order
        for part in (order, left, factor):
            part[[k, at]] = part[[at, k]]
        factor[k, k] = left[k] ** 0.5
        factor[k + 1:, k] = (v[order[k + 1:], order[k]] - factor[k + 1:, :k] @ factor[k, :k]) / factor[k, k]
        left[k + 1:] -= factor[k + 1:, k] ** 2
    return factor, order


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """``factor`` times rotations, its columns orthogonal to working precision.
    A round rotates disjoint pairs of columns at once."""
    a = factor.copy()
    r = a.shape[1]
    if r < 2:
        return a
    seats = list(range(r)) + [-1] * (r % 2)
    close = np.finfo(float).eps * max(len(a), 8)
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(seats) - 1):
            half = len(seats) // 2
            pairs = [(p, q) for p, q in zip(seats[:half], seats[:half - 1:-1]) if min(p, q) >= 0]
            p, q = np.array(pairs).T
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            size = np.sqrt(xx * yy)
            turn = np.abs(xy) > close * size
            if turn.any():
                worst = max(worst, float((np.abs(xy[turn]) / size[turn]).max()))
                zeta = (yy - xx) / np.where(turn, 2 * xy, 1)
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
                c = np.where(turn, 1 / np.sqrt(1 + t * t), 1.0)
                s = np.where(turn, c * t, 0.0)
                a[:, p], a[:, q] = c * x - s * y, s * x + c * y
            seats = [seats[0], seats[-1], *seats[1:-1]]
        if worst <= close:
            break
    return a


def components(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues by falling size, unit eigenvectors as columns) of a covariance."""
    d = len(v)
    factor, order = pivoted_cholesky(v)
    turned = one_sided_jacobi(factor)
    norms = np.sqrt((turned * turned).sum(0))
    by_size = np.argsort(-norms, kind="stable")
    vectors = np.zeros((d, d))
    rank = len(norms)
    vectors[order, :rank] = (turned / norms)[:, by_size]
    if rank < d:        # any unit vectors at right angles to the others have variance 0
        full, _ = np.linalg.qr(np.hstack([vectors[:, :rank], np.eye(d)]))
        vectors[:, rank:] = full[:, rank:d]
    return np.concatenate([norms[by_size] ** 2, np.zeros(d - rank)]), vectors


def _upper(batches: Iterator[pa.RecordBatch], measure, dim: int, width: int) -> Iterator[pa.RecordBatch]:
    """One row per entry of the upper triangle of the sum of y'y, y = measure(x)."""
    total, any_rows = np.zeros((width, width)), False
    for batch in batches:
        if batch.num_rows:
            y = measure(_matrix(batch, dim))
            total += y.T @ y
            any_rows = True
    if any_rows:
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
                                         ["i", "j", "v"])


def _scatter(vectors: DataFrame, measure, dim: int, width: int) -> np.ndarray:
    parts = vectors.mapInArrow(lambda b: _upper(b, measure, dim, width), "i int, j int, v double")
    rows = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()      # width squared rows at most
    out = np.zeros((width, width))
    i, j, v = (rows.column(c).to_numpy() for c in ("i", "j", "v"))
    out[i, j] = v
    out[j, i] = v
    return out


def _sums(vectors: DataFrame, dim: int) -> list[int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = [0] * dim, False
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch, dim)
                part = x.sum(0) if _top(x) * len(x) < WIDE else x.astype(object).sum(0)
                total = [a + int(b) for a, b in zip(total, part)]
                any_rows = True
        if any_rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dim), pa.int32()), pa.array(map(Decimal, total), pa.decimal128(38, 0))], ["i", "s"])
    rows = vectors.mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()
    return [int(r.s) for r in sorted(rows)]


def distinct_vectors(rows: DataFrame, vec_col: str) -> DataFrame:
    """x: each distinct integer vector once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, lengths, x = integers(batch.column(0))
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, x)], ["x"])
    return rows.select(F.col(f"`{vec_col}`").cast("array<double>").alias("v")) \
        .mapInArrow(run, "x array<bigint>").distinct()


def fit(rows: DataFrame, vec_col: str = "embedding", components_kept: int = 4) -> Whitening | None:
    """The model of all rows of the table; None if no row has a whole vector."""
    distinct = staged(distinct_vectors(rows, vec_col), "vectors")
    try:
        known = distinct.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1)
        top = known.collect()
        if not top:
            return None
        dim, n = top[0]["dim"], top[0]["count"]
        vectors = distinct.filter(F.size("x") == dim)
        sums = tuple(_sums(vectors, dim)) if dim else ()
        raw = Whitening(n, sums, np.zeros(0), np.zeros((dim, 0)), 0.0)
        v = _scatter(vectors, raw.centred, dim, dim) / n
        values, axes = components(v)
        model = Whitening(n, sums, values, axes, float(v.trace()))
        k = int((values[:components_kept] > 0).sum())
        if not k:
            return model
        spread = _scatter(vectors, lambda x: model.project(x, k), dim, k) / n
        return Whitening(n, sums, values, axes, model.trace, float(np.abs(spread - np.eye(k)).max()))
    finally:
        drop_staged(distinct)


def whiten(rows: DataFrame, model: Whitening | None, vec_col: str = "embedding",
           components_kept: int = 4) -> DataFrame:
    """Rows with a whole vector, without it, with n, deviation, whitened and
    explained (one entry per component) and identity_error."""
    added = StructType.fromDDL(ADDED)
    kept = without(rows, vec_col, *added.names)
    passed = [rows[f"`{c}`"] for c in kept.columns]
    vector = rows[f"`{vec_col}`"].cast("array<double>").alias(fresh("vector", kept))
    slim, back = undotted(rows.select(*passed, vector))
    names = slim.columns[:-1]
    schema = StructType([*slim.schema.fields[:-1], *added.fields])
    if model is None:
        return kept.sparkSession.createDataFrame([], schema).withColumnsRenamed(back)
    k = min(components_kept, model.dim)
    share = model.explained(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at, lengths, x = integers(batch.column(batch.num_columns - 1))
            right = lengths == model.dim
            x = x[np.repeat(right, lengths)].reshape(-1, model.dim)
            at, m = at[right], int(right.sum())
            if not m:
                continue
            white = model.project(x, k).ravel()
            offsets = np.arange(0, k * m + 1, max(k, 1), dtype=np.int32) if k else np.zeros(m + 1, np.int32)
            far = [Decimal(v) if v < 10**38 else None for v in model.deviation(x)]
            yield pa.RecordBatch.from_arrays(
                [*batch.take(pa.array(at)).columns[:-1], pa.array([model.n] * m, pa.int64()),
                 pa.array(far, pa.decimal128(38, 0)),
                 pa.ListArray.from_arrays(offsets, pa.array(white, mask=np.isnan(white))),
                 pa.array([share] * m, pa.list_(pa.float64())),
                 pa.array([model.identity_error] * m, pa.float64())],
                [*names, *added.names])

    return slim.mapInArrow(run, schema).withColumnsRenamed(back)
