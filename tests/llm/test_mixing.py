from __future__ import annotations

import numpy as np
import pytest

from deskmetrics.llm import mixing, queries

from .conftest import SF

def solve_plainly(n, p, goal, rounds=60_000):
    """Plain projected gradient on whole arrays, long enough to settle."""
    total, typical = n.sum(), n.mean()
    weight = n / (n + typical)
    curve = (p * (n * weight)[:, None]).T @ p / total
    step = 1 / (1 + np.linalg.eigvalsh(curve).max() / mixing.PULL)
    rate = np.ones(len(n))
    for _ in range(rounds):
        gap = (n * rate) @ p / total - goal
        new = np.clip(rate - step * (weight * (p @ gap) / mixing.PULL + rate - 1), 0, mixing.MAX_RATE)
        if np.abs(new - rate).max() < 1e-9:
            break
        rate = new
    return rate


@pytest.fixture(scope="module")
def rates(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return mixing.document_rates(docs, queries.domains(spark, SF)).toPandas()


def test_rates_match_projected_gradient_on_arrays(rates):
    p = np.stack(rates["posterior"])
    np.testing.assert_allclose(p.sum(1), 1, atol=1e-9)
    goal = np.array([mixing.TARGETS[c[2:]] for c in rates.columns if c.startswith("p_")])
    want = solve_plainly(rates["n_tokens"].to_numpy(float), p, goal)
    np.testing.assert_allclose(rates["rate"], want, atol=0.05)
    assert rates["rate"].between(0, mixing.MAX_RATE).all()


def test_rates_are_the_optimum(rates):
    """No rate inside the box has a slope, those at its ends point outwards."""
    n, p, r = rates["n_tokens"].to_numpy(float), np.stack(rates["posterior"]), rates["rate"].to_numpy()
    goal = np.array([mixing.TARGETS[c[2:]] for c in rates.columns if c.startswith("p_")])
    gap = (n * r) @ p / n.sum() - goal
    free = 1 - n / (n + n.mean()) * (p @ gap) / mixing.PULL
    np.testing.assert_allclose(r, np.clip(free, 0, mixing.MAX_RATE), atol=0.05)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_good_documents_stay_and_toxic_ones_go(spark, sf):
    """Judged on labelled rows that the learner did not see."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text")
    labelled = queries.domains(spark, f"/root/testdata/{sf}")
    rows = mixing.document_rates(docs, labelled.filter("doc_id % 2 = 1")) \
        .join(labelled.filter("doc_id % 2 = 0"), "doc_id").toPandas()
    good, toxic = rows[rows["domain"] == "good"], rows[rows["domain"] == "toxic"]
    taken = rows["n_tokens"] * rows["rate"]
    assert (good["rate"] > 0).mean() >= 0.8 and good["rate"].mean() > 0.8
    assert taken[toxic.index].sum() < 0.02 * taken.sum()
    assert rows["rate"].max() <= mixing.MAX_RATE


def test_classifier_on_rows_it_did_not_learn_from(spark):
    """Learn from odd ids, judge even ones."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labelled = queries.domains(spark, sf)
    classifier = mixing.learn(docs, labelled.filter("doc_id % 2 = 1"))
    rows = mixing.with_posteriors(docs, classifier).join(labelled.filter("doc_id % 2 = 0"), "doc_id").collect()
    right = [classifier.domains[int(np.argmax(r.posterior))] == r.domain for r in rows]
    assert np.mean(right) > 0.85


def test_query_and_copies(spark):
    out = queries.op2_soft_mixing(spark, SF).toPandas()
    assert len(out) == 200 and {"doc_id", "rate", "copies", "p_good"} <= set(out.columns)
    assert ((out["copies"] - out["rate"]).abs() < 1).all()
    assert abs(out["copies"].mean() - out["rate"].mean()) < 0.15


def test_edge_rows(edge_docs, edge_rows, clashing_docs, no_docs):
    spark = edge_docs.sparkSession
    labelled = spark.createDataFrame([(1, "good"), (2, "good"), (5, "low"), (8, "low"), (9, "low"), (None, "low"),
                                      (10, None), (99, "toxic")], "doc_id long, domain string")
    rows = mixing.document_rates(edge_docs, labelled).collect()
    assert len(rows) == len(edge_rows) and all(r.rate >= 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (4, 5, 6)} == {0}
    none = spark.createDataFrame([], "doc_id long, domain string")
    assert {round(r.rate, 6) for r in mixing.document_rates(edge_docs, none).collect()} == {1.0}
    mixed = mixing.mix(clashing_docs, none)
    assert mixed.columns == clashing_docs.columns and mixed.count() == len(edge_rows)
    assert "rate" in mixing.document_rates(clashing_docs, none).columns
    assert mixing.document_rates(no_docs, labelled).collect() == [] == mixing.mix(no_docs, labelled).collect()


def _members(spark, p, n):
    rows = [(i, int(n[i]), p[i].tolist()) for i in range(len(n))]
    return spark.createDataFrame(rows, "doc_id long, n_tokens long, posterior array<double>").coalesce(2)


def _rates(members, fit):
    got = mixing.with_rates(members, fit).select("doc_id", "rate").collect()
    return np.array([r.rate for r in sorted(got)])


@pytest.mark.parametrize("shares", [(.95, .03, .02)])
def test_small_domains_come_near_the_production_targets(spark, shares):
    rnd = np.random.default_rng(5)
    d = rnd.choice(3, 3000, p=shares)
    z = rnd.normal(0, 1, (3000, 3))
    z[np.arange(3000), d] += 12
    p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    n = rnd.integers(0, 500, 3000)
    want = np.array([mixing.TARGETS[x] for x in ("good", "low", "toxic")])
    members = _members(spark, p, n)
    fit = mixing.solve(members, want * n.sum())
    rate = _rates(members, fit)
    off = rate - solve_plainly(n.astype(float), p, want)
    assert np.sqrt(np.mean(off ** 2)) < 0.01 and np.abs(off).max() < 0.5
    np.testing.assert_allclose((n * rate) @ p / n.sum(), fit.shares, atol=1e-5)
    assert (n * rate)[d == 2].sum() < 0.01 * n.sum() and (rate[d == 0] > 0.5).all()
    assert fit.residual == pytest.approx(np.abs(fit.shares - want).max())
    assert (rate[n == 0] == 1).all()


def test_targets_out_of_reach_report_the_residual(spark):
    p, n = np.array([[.8, .1, .1], [.7, .1, .2], [.2, .7, .1], [.1, .1, .8]]), np.array([100, 50, 80, 90])
    members = _members(spark, p, n)
    fit = mixing.solve(members, np.array([0, 0, 1.0]) * n.sum())
    rate = _rates(members, fit)
    np.testing.assert_allclose(rate, solve_plainly(n.astype(float), p, np.array([0, 0, 1.0])), atol=0.05)
    assert fit.residual > 0.05 and rate.max() <= mixing.MAX_RATE and rate[3] > 1 > rate[2]
