from __future__ import annotations

import numpy as np
import pyarrow as pa

from deskmetrics.llm import features, pairwise_rank, queries

from . import brute

CHECK = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in queries.op4_pairwise_rank(spark, CHECK).collect()}
    labels = spark.read.parquet(f"{CHECK}/labels.parquet").collect()
    assert len(rows) == spark.read.parquet(f"{CHECK}/documents.parquet").count()
    for k, r in rows.items():
        assert r.held_out == (brute.crc(k) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(rows[x.doc_id], x.quality) for x in labels if rows[x.doc_id].held_out]
    assert np.mean([r.predicted == q for r, q in held]) > 0.9
    ones, zeros = [[r.score for r, q in held if q == k] for k in (1, 0)]
    assert np.mean([a > b for a in ones for b in zeros]) > 0.97


def test_fit_orders_pairs_and_cuts_at_the_quantile():
    rng = np.random.default_rng(1)
    y = (rng.random(600) < 0.75).astype(int)
    x = rng.normal(0, 1, (600, 4))
    x[:, 2] += 4 * y
    ranking = pairwise_rank.fit(x, y, 0.25, 5000, 1e-3)
    assert np.argmax(np.abs(ranking.weights)) == 2
    s = ranking.scores(x)
    assert np.mean((s >= pairwise_rank.THRESHOLD) == (y == 1)) > 0.95
    assert abs(np.mean(s < pairwise_rank.THRESHOLD) - np.mean(y == 0)) < 0.05
    assert pairwise_rank.fit(x, np.ones(600, int), 0.0, 10, 1e-3) is None


def test_labels_are_no_input(spark):
    """Other lang, source and id values give the same scores."""
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{CHECK}/documents.parquet").filter("doc_id < 50")
    ranking = pairwise_rank.Ranking(np.zeros(len(features.NAMES)), np.ones(len(features.NAMES)),
                                    np.arange(len(features.NAMES)) / 10)
    a = [r.score for r in pairwise_rank.score(docs, ranking).orderBy("doc_id").collect()]
    other = docs.withColumn("doc_id", F.col("doc_id") + 10**6).withColumn("lang", F.lit("xx"))
    assert a == [r.score for r in pairwise_rank.score(other, ranking).orderBy("doc_id").collect()]


def test_edge_rows(edge_docs, edge_rows, clashing_docs, no_docs):
    spark = edge_docs.sparkSession
    labels = spark.createDataFrame([(1, 1), (10, 1), (5, 0), (14, 0), (None, 1), (7, None), (77, 0)],
                                   "doc_id long, quality int")
    ranking = pairwise_rank.learn(edge_docs, labels)
    rows = pairwise_rank.score(edge_docs, ranking).collect()
    assert len(rows) == len(edge_rows) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (4, 5, 6)}) == 1
    out = pairwise_rank.score(clashing_docs, ranking)
    assert out.columns.count("score") == 1 and out.count() == len(edge_rows)
    assert pairwise_rank.learn(edge_docs, labels.filter("quality = 1")) is None
    assert {r.score for r in pairwise_rank.score(edge_docs, None).collect()} == {0.5}
    assert pairwise_rank.score(no_docs, ranking).collect() == []


def test_learns_from_every_label(spark):
    """More labels than the fit once took: the ranking is the one of all rows
    in memory, and the cut has as many training scores below it as zeros."""
    n = 21_000
    text = lambda i: "word " * (1 + i % 3) + ("| " * (i % 4) if i % 5 < 2 else "End. ") + "x" * (i % 37)
    docs = spark.createDataFrame([(i, text(i)) for i in range(n)], "doc_id long, text string")
    label = [int(i % 5 >= 2 or i % 11 == 0) for i in range(n)]
    labels = spark.createDataFrame(list(enumerate(label)), "doc_id long, quality int")
    got = pairwise_rank.learn(docs, labels)
    x, y = features.style(pa.array([text(i) for i in range(n)])), np.array(label)
    want = pairwise_rank.fit(x, y, float(np.mean(y == 0)), pairwise_rank.CELLS, 1e-3)
    np.testing.assert_allclose(got.mean, x.mean(0), atol=1e-9)
    np.testing.assert_allclose(got.weights, want.weights, atol=1e-6)
    assert abs(got.cut - want.cut) < 1e-6 and abs(got.spread - want.spread) < 1e-6
    raw = np.sort(pairwise_rank._scaled(x, got.mean, got.scale) @ got.weights)
    zeros = int(np.sum(y == 0))
    assert raw[zeros - 1] - 1e-9 <= got.cut <= raw[zeros] + 1e-9
