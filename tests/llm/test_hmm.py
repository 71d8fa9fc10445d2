from __future__ import annotations

import itertools
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from deskmetrics.llm import hmm, queries

from . import brute
from .conftest import SF

SMALL = hmm.Settings(states=3, iterations=2, top_words=50, classes=8, segment=64, prior=50.0)


@pytest.fixture
def tiny():
    rng = np.random.default_rng(0)
    m = hmm.Model(hmm.Settings(states=3), np.zeros(0), np.zeros(0), np.zeros(1))
    m.start, m.move, m.emit = rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(6), 3).T
    return m, rng.integers(0, 6, 8).astype(np.int32), np.array([4, 1, 3])


def test_recursions_match_the_sum_over_all_paths(tiny):
    m, ids, lengths = tiny
    emits, moves, starts = np.zeros((6, 3)), np.zeros((3, 3)), np.zeros(3)
    at, logs = 0, hmm.forward_log10(m, ids, lengths)
    for i, n in enumerate(lengths):
        x, at = ids[at:at + n], at + n
        paths = {p: m.start[p[0]] * np.prod([m.emit[a, b] for a, b in zip(x, p)])
                 * np.prod([m.move[a, b] for a, b in zip(p, p[1:])]) for p in itertools.product(range(3), repeat=n)}
        total = sum(paths.values())
        assert math.isclose(logs[i], math.log10(total), rel_tol=1e-12)
        for p, weight in paths.items():
            starts[p[0]] += weight / total
            for a, b in zip(x, p):
                emits[a, b] += weight / total
            for a, b in zip(p, p[1:]):
                moves[a, b] += weight / total
    for got, want in zip(hmm.expected_counts(m, ids, lengths), (emits, moves, starts)):
        np.testing.assert_allclose(got, want, atol=1e-6)


def test_parts_of_a_text_count_what_the_whole_counts(tiny):
    """Every token, move and start once; with enough context almost the same expectations."""
    m, _, _ = tiny
    m.move = 0.7 * np.eye(3) + 0.3 * m.move
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 6, n).astype("<u2") for n in (1, 50, 99, 100, 101, 1000)]
    batch = pa.RecordBatch.from_arrays([pa.array([t.tobytes() for t in texts], pa.binary())], ["ids"])
    lengths = np.array([len(t) for t in texts])
    whole = hmm.expected_counts(m, np.concatenate(texts).astype(np.int32), lengths)
    gaps = {}
    for context in (1, 30, 100):
        (ids, sizes, own), = hmm._parts(iter([batch]), 50, context)
        assert (own[:, 1] - own[:, 0]).sum() == lengths.sum() and (own[:, 0] == 0).sum() == len(texts)
        parts = hmm.expected_counts(m, ids, sizes, own)
        for got, total in zip(parts, (lengths.sum(), lengths.sum() - len(texts), len(texts))):
            assert math.isclose(got.sum(), total, rel_tol=1e-5)
        np.testing.assert_allclose(parts[0].sum(1), np.bincount(np.concatenate(texts), minlength=6), rtol=1e-5)
        gaps[context] = max(np.abs(a - b).max() for a, b in zip(parts, whole))
    assert gaps[30] < 1e-2 and gaps[30] < gaps[1]


def test_base_columns_and_gain_over_the_base(spark, sf_texts):
    rows = queries.op1_hidden_markov(spark, SF).collect()
    tokens = {k: [*brute.words(brute.lower(t or "")), None] for k, t in sf_texts.items()}
    count = Counter(w for k, t in tokens.items() if brute.crc(k) % 7 != 2 for w in t)
    n, v = sum(count.values()), len(count)
    assert {r.doc_id for r in rows} == set(tokens)
    for r in rows:
        own = tokens[r.doc_id]
        assert r.held_out == (brute.crc(r.doc_id) % 7 == 2)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(w in count for w in own), n)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own), rel_tol=1e-9)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 for r in rows)


def test_probabilities_of_one_word_texts_sum_to_at_most_one(spark):
    """Known words, and one unseen word of each class, followed by the end."""
    known = [f"k{i}" for i in range(30)]
    docs = [(i, " ".join(known[i % 30:] + known[:3])) for i in range(200)] + \
        [(1000 + i, w) for i, w in enumerate([*known, *(f"zz{i}q" for i in range(300))])]
    from pyspark.sql import functions as F
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = hmm.train_and_score(df, is_held_out=F.col("doc_id") >= 1000, settings=SMALL).collect()
    scores = [10 ** r.score for r in rows if 1000 <= r.doc_id < 1030]
    unseen = {round(r.score, 9) for r in rows if r.doc_id >= 1030}
    assert len(unseen) <= SMALL.classes
    assert sum(scores) + sum(10 ** u for u in unseen) <= 1.0


def test_edge_rows(edge_docs, edge_rows, clashing_docs, no_docs):
    rows = hmm.train_and_score(edge_docs, settings=SMALL).collect()
    assert len(rows) == len(edge_rows)
    by_id = {}
    for r in rows:
        assert math.isfinite(r.score) and r.n_tokens == len(brute.words(dict((x[0], x[1]) for x in edge_rows
                                                                             if x[0] == r.doc_id).get(r.doc_id))) + 1 \
            or r.doc_id is None
        if r.doc_id is not None:
            assert math.isclose(by_id.setdefault(r.doc_id, r.score), r.score, rel_tol=1e-9)
    assert {r.n_tokens for r in rows if r.doc_id in (4, 5, 6)} == {1}
    again = hmm.train_and_score(clashing_docs.repartition(3), settings=SMALL).collect()
    assert all(math.isclose(by_id[r.doc_id], r.score, rel_tol=1e-3) for r in again if r.doc_id is not None)
    assert hmm.train_and_score(no_docs, settings=SMALL).collect() == []
