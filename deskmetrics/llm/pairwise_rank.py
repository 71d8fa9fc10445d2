"""Quality classifier by Bradley-Terry pairwise ranking.

Preference pairs are a labelled 1 over a labelled 0.  A document's score is
linear in its features; the probability that one is preferred is the logistic
function of the score difference, so the weights are fitted by logistic loss
on feature differences (Newton steps with a ridge).  The cut between the
classes is a quantile of the training scores: the share of training zeros.

The fit takes every labelled row and every pair of a 1 and a 0.  A pass over
the rows puts the scores of the weights so far into ``CELLS`` cells and adds up
rows and features by cell and label; the pairs of two cells have the difference
of the cells' mean scores (a cell is so narrow that this is off by about 1e-5
of a chance).  A second pass adds up the curvature.  The driver holds the sums
of the cells only.  The cut is the exact order statistic of all training scores.

Defined results: a NULL or empty text has features of zero and is scored like
any other; repeated rows are scored alike; a NULL id counts as the text '' in
the split; labels that are NULL or without a document are left out, repeated
labels weigh double; without labels of both kinds every score is 0.5; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from . import features
from .common import drop_staged, staged, undotted, without

THRESHOLD = 0.3
#: Cells of the scores in a pass of the fit.
CELLS = 4096


@dataclass(frozen=True)
class Ranking:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float = 0.0          # the quantile of the training scores
    spread: float = 1.0

    def scores(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; THRESHOLD at the cut."""
        raw = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights
        z = (raw - self.cut) / self.spread + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _scaled(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / scale, -8, 8)


def _keys(z: np.ndarray, y: np.ndarray, w: np.ndarray, width: float) -> np.ndarray:
    """Cell and label of each row as one number."""
    return np.floor(z @ w / width).astype(np.int64) * 2 + y


def _by_cell(z: np.ndarray, y: np.ndarray, w: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
    """The keys there are, and the number of rows and the sums of ``z`` of each."""
    keys, at = np.unique(_keys(z, y, w, width), return_inverse=True)
    columns = [np.ones(len(z)), *z.T]
    return keys, np.stack([np.bincount(at, c, len(keys)) for c in columns], 1)


def _outer(z: np.ndarray, y: np.ndarray, w: np.ndarray, width: float, keys: np.ndarray,
           weights: np.ndarray) -> np.ndarray:
    """The sum of the rows' outer products, each with the weight of its key."""
    at = np.minimum(np.searchsorted(keys, _keys(z, y, w, width)), len(keys) - 1)
    return (z * weights[at, None]).T @ z


def _pairs(keys: np.ndarray, sums: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the loss over all pairs (not divided by their number): its falling
    gradient, each key's weight in the curvature, and the products of rows of
    different labels that the curvature lacks."""
    good, bad = keys % 2 == 1, keys % 2 == 0
    n, z = sums[:, 0], sums[:, 1:]
    s = z @ w / n
    gradient, cross, weights = np.zeros(len(w)), np.zeros((len(w), len(w))), np.zeros(len(keys))
    for rows in np.array_split(np.flatnonzero(good), 1 + np.count_nonzero(good) // 256):
        p = 1 / (1 + np.exp(np.clip(s[rows, None] - s[bad], -30, 30)))       # chance of the other order
        gradient += z[rows].T @ (p @ n[bad]) - z[bad].T @ (p.T @ n[rows])
        p *= 1 - p
        weights[rows] = p @ n[bad]
        weights[bad] += p.T @ n[rows]
        cross += z[rows].T @ (p @ z[bad])
    return gradient, weights, cross


def _solve(by_cell, outer, d: int, cells: int, ridge: float) -> np.ndarray:
    """The weights by Newton steps.  ``by_cell`` and ``outer`` are the passes of
    these names over all rows.  Weights are rounded, so that the order in which
    partitions are added up does not show."""
    w = np.zeros(d)
    for _ in range(25):
        width = max(16 * np.abs(w).sum() / cells, 1e-12)       # scores are within 8 of each weight
        keys, sums = by_cell(w, width)
        gradient, weights, cross = _pairs(keys, sums, w)
        curve = outer(w, width, keys, weights) - cross - cross.T
        pairs = sums[keys % 2 == 1, 0].sum() * sums[keys % 2 == 0, 0].sum()
        step = np.linalg.solve(curve / pairs + ridge * np.eye(d), gradient / pairs - ridge * w)
        w = np.round(w + step, 12)
        if np.abs(step).max() < 1e-6:
            break
    return w


def _below(share: float, n: int) -> int:
    """Rows below the cut: the share at most, but for rounding."""
    return int(share * n + 1e-9 * n)


def fit(x: np.ndarray, y: np.ndarray, zero_share: float, cells: int, ridge: float) -> Ranking | None:
    """The ranking of rows in memory.  ``zero_share``: the share below the cut."""
    if len(np.unique(y)) < 2:
        return None
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = _scaled(x, mean, scale)
    w = _solve(lambda *a: _by_cell(z, y, *a), lambda *a: _outer(z, y, *a), x.shape[1], cells, ridge)
    raw = np.sort(z @ w)
    at = _below(zero_share, len(raw))
    return Ranking(mean, scale, w, float(raw[max(at - 1, 0)] + raw[min(at, len(raw) - 1)]) / 2,
                   float(raw.std()) / 4 + 1e-9)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x = features.style(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1])
                 .cast(pa.list_(pa.float64()))], ["id", "x"])


def _summed(rows: DataFrame, measure, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``measure`` gives keys and ``width`` numbers a key of some rows (x, y);
    returns all keys and their sums over all rows."""
    names = [f"s{i}" for i in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
                keys, sums = measure(x, batch.column(0).to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(keys), *map(pa.array, sums.T.copy())], ["k", *names])

    found = rows.select("y", "x").mapInArrow(run, "k bigint, " + ", ".join(f"{c} double" for c in names)) \
        .groupBy("k").agg(*[F.sum(c).alias(c) for c in names]).toArrow().sort_by("k")
    return found.column("k").to_numpy(), np.stack([found.column(c).to_numpy() for c in names], 1)


def _nth(raw: DataFrame, rank: int, bound: float) -> float:
    """The value with ``rank`` smaller or equal ones before it (column raw, all
    within ``bound``): each pass looks into the cell of the last one that holds
    it, until the cell has one value."""
    lo, hi = -bound, bound
    while True:
        share = (F.col("raw") - F.lit(lo)) / F.lit(hi - lo)
        cells = raw.filter(F.col("raw").between(lo, hi)) \
            .groupBy(F.least(F.floor(share * F.lit(float(CELLS))), F.lit(CELLS - 1)).alias("c")) \
            .agg(F.count("*").alias("n"), F.min("raw").alias("lo"), F.max("raw").alias("hi")).orderBy("c").collect()
        for cell in cells:
            if rank < cell.n:
                break
            rank -= cell.n
        lo, hi = cell.lo, cell.hi
        if lo == hi:
            return lo


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", cells: int = CELLS, ridge: float = 1e-3) -> Ranking | None:
    """The ranking from all labelled documents (``labels`` holds training rows only)."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")) \
        .filter("id is not null and y in (0, 1)")
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("id is not null")
    # measured first: the join moves numbers and no texts
    measured = src.mapInArrow(_measured, src.select("id").schema.add("x", ArrayType(DoubleType())))
    rows = staged(measured.join(known, "id").select("y", "x"), "labelled")
    d = len(features.NAMES)
    by_label, sums = _summed(rows, lambda x, y: _by_cell(x, y, np.zeros(d), 1.0), d + 1)
    if len(by_label) < 2:
        drop_staged(rows)
        return None
    n = int(sums[:, 0].sum())
    mean = np.round(sums[:, 1:].sum(0) / n, 12)
    squares = _summed(rows, lambda x, y: (np.zeros(1, np.int64), ((x - mean) ** 2).sum(0)[None]), d)[1][0]
    scale = np.round(np.sqrt(squares / n), 12) + 1e-6

    def by_cell(w: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
        return _summed(rows, lambda x, y: _by_cell(_scaled(x, mean, scale), y, w, width), d + 1)

    def outer(w: np.ndarray, width: float, keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
        one = lambda x, y: (np.arange(d), _outer(_scaled(x, mean, scale), y, w, width, keys, weights))
        return _summed(rows, one, d)[1]

    w = _solve(by_cell, outer, d, cells, ridge)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([pa.array(_scaled(x, mean, scale) @ w)], ["raw"])

    raw = staged(rows.select("x").mapInArrow(scores, "raw double"), "training-scores")
    at, bound = int(sums[by_label == 0, 0][0]), 8 * float(np.abs(w).sum()) + 1.0
    cut = (_nth(raw, at - 1, bound) + _nth(raw, at, bound)) / 2
    spread = raw.agg(F.stddev_pop("raw")).first()[0]
    drop_staged(rows, raw)
    return Ranking(mean, scale, w, cut, float(np.round(spread, 12)) / 4 + 1e-9)


def score(docs: DataFrame, ranking: Ranking | None, text_col: str = "text",
          out_col: str = "score") -> DataFrame:
    """``docs`` without the text and with ``out_col``; an input column of that
    name is replaced."""
    docs, back = undotted(without(docs, out_col))
    kept = [c for c in docs.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                s = np.full(batch.num_rows, 0.5) if ranking is None else \
                    ranking.scores(features.style(batch.column(text_col)))
                yield pa.RecordBatch.from_arrays([*batch.select(kept).columns, pa.array(s)], [*kept, out_col])

    schema = docs.select(*kept).schema.add(out_col, "double")
    return docs.mapInArrow(run, schema).withColumnsRenamed(back)
