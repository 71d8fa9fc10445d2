from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from deskmetrics.llm import queries, whitening

from .conftest import SF

ROWS = [(1, [0.1, 0.2, -0.3]), (2, [0.1, 0.2, -0.3]), (3, [0.5, -0.25, 0.75]), (4, [1.5, 0.0, -0.0]),
        (5, [-0.7, 0.9, 0.3]), (6, [0.3, 0.3, 0.1]), (7, None), (8, []), (9, [0.1, None, 0.2]),
        (10, [float("nan"), 0.0, 0.0]), (11, [float("inf"), 0.0, 0.0]), (12, [1.0, 2.0]), (None, [0.5, 0.5, 0.5]),
        (1, [0.1, 0.2, -0.3])]
SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, k=4):
    """The contract on lists of (id, vector) by whole arrays and a library's eigenvectors."""
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    sizes = [len(x) for x in {tuple(x) for _, x in kept}]
    dim = max(set(sizes), key=lambda d: (sizes.count(d), d))
    kept = [(i, x) for i, x in kept if len(x) == dim]
    fit = np.array(sorted({tuple(x) for _, x in kept}))
    n, s = len(fit), fit.sum(0)
    c = fit - s / n
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    out = []
    for i, x in kept:
        far = sum((n * a - int(b)) ** 2 for a, b in zip(x, s))
        out.append((i, n, far, ((np.array(x) - s / n) @ u) / np.sqrt(e), e / np.trace(v)))
    return out


def test_query_matches_whole_arrays(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = {i: rest for i, *rest in plain(rows)}
    got = queries.op11_whitening(spark, SF).collect()
    assert len(got) == 4 * len(want)
    signs = {}
    for r in got:
        n, far, white, explained = want[r.vec_id]
        at = r.component - 1
        assert (r.n, r.deviation) == (n, far)
        assert r.explained == pytest.approx(explained[at], rel=1e-9) and 0 <= r.identity_error < 1e-9
        sign = signs.setdefault(at, 1 if r.whitened * white[at] > 0 else -1)
        assert sign * r.whitened == pytest.approx(white[at], rel=1e-6, abs=1e-8)


def test_edge_rows(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    want = plain(ROWS)
    model = whitening.fit(df)
    got = whitening.whiten(df.withColumn("n", F.lit(1)).withColumn("a.b", F.lit(2)), model).collect()
    assert sorted((r.vec_id or 0) for r in got) == sorted((i or 0) for i, *_ in want)
    assert [(r.n, int(r.deviation)) for r in sorted(got, key=lambda r: r.vec_id or 0)] == \
        [(n, far) for _, n, far, *_ in sorted(want, key=lambda w: w[0] or 0)]
    assert all(len(r.whitened) == 3 and r["a.b"] == 2 for r in got) and model.identity_error < 1e-12


def test_no_variance_and_no_rows(spark):
    one = spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5])], SCHEMA)
    got = whitening.whiten(one, whitening.fit(one)).collect()
    assert [(r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in got] == \
        [(1, 0, [None, None], [None, None], None)] * 2
    two = spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.0, 0.5])], SCHEMA)
    got = whitening.whiten(two, whitening.fit(two)).collect()
    assert all(abs(abs(r.whitened[0]) - 1) < 1e-12 and r.whitened[1] is None for r in got)
    assert got[0].explained == pytest.approx([1.0, 0.0])
    none = spark.createDataFrame([(1, None)], SCHEMA)
    assert whitening.whiten(none, whitening.fit(none)).collect() == []
    assert whitening.whiten(none.limit(0), whitening.fit(none.limit(0))).collect() == []


def test_large_values_stay_exact(spark):
    rows = [(i, [1e15 + 4.0 * i, 3.0 * i * i, 1e38 if i == 0 else 1.0]) for i in range(6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    model = whitening.fit(df)
    x = [[min(math.floor(256 * c), 2**63 - 1) for c in v] for _, v in rows]
    assert list(model.sums) == [sum(c) for c in zip(*x)]
    far = {i: sum((6 * a - s) ** 2 for a, s in zip(x[i], model.sums)) for i in range(6)}
    got = {r.vec_id: r.deviation for r in whitening.whiten(df, model).collect()}
    assert {i: (None if d is None else int(d)) for i, d in got.items()} == \
        {i: (f if f < 10**38 else None) for i, f in far.items()}


@pytest.mark.parametrize("d", [1, 2, 5, 33])
def test_components_are_eigenvectors(d):
    rng = np.random.default_rng(d)
    x = rng.normal(size=(200, d)) * np.logspace(0, -4, d)
    v = np.cov(x.T, bias=True).reshape(d, d)
    e, u = whitening.components(v)
    assert np.all(np.diff(e) <= 0)
    np.testing.assert_allclose(e, np.linalg.eigvalsh(v)[::-1], rtol=1e-8)
    np.testing.assert_allclose(u.T @ u, np.eye(d), atol=1e-12)
    np.testing.assert_allclose(u * e @ u.T, v, atol=1e-13)


def test_pivoted_cholesky_of_a_low_rank():
    rng = np.random.default_rng(1)
    b = rng.normal(size=(6, 3))
    factor, order = whitening.pivoted_cholesky(b @ b.T)
    assert factor.shape == (6, 3) and np.allclose(np.triu(factor[:3], 1), 0)
    np.testing.assert_allclose(factor @ factor.T, (b @ b.T)[np.ix_(order, order)], atol=1e-12)
    e, u = whitening.components(b @ b.T)
    assert (e[3:] == 0).all() and np.allclose(u.T @ u, np.eye(6))
