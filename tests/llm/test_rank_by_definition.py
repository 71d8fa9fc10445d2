"""The pairwise ranking against plain definitions: features word by word, the
fit by gradient descent over all pairs, the query by both."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pyarrow as pa

from deskmetrics.llm import features, pairwise_rank, queries
from deskmetrics.llm.common import held_out

from .conftest import SF

SYMBOLS, MARKS = b"#*$%&|<>{}[]\\^~_=+/@", b".,;:!?'\"()-"


def plain(text: str | None) -> list[float]:
    raw = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    if not words:
        return [0.0] * len(features.NAMES)
    n, size = len(words), len(raw)
    of_words = lambda test: sum(map(test, words)) / n       # noqa: E731
    of_bytes = lambda test: sum(map(test, raw)) / size      # noqa: E731
    low = [w.lower() for w in words]        # words are told apart without regard to A-Z case
    windows = [low[i:i + features.WINDOW] for i in range(0, n, features.WINDOW)]
    lines = [p for p in raw.split(b"\n") if p.strip()]
    return [
        math.log1p(n), sum(map(len, words)) / n / 10, of_words(lambda w: len(w) > 20),
        of_bytes(lambda b: 65 <= b <= 90), of_bytes(lambda b: 48 <= b <= 57), of_bytes(lambda b: b in SYMBOLS),
        of_bytes(lambda b: b in MARKS), of_bytes(lambda b: b < 32 and b != 10), of_bytes(lambda b: b >= 128),
        of_words(lambda w: w.endswith(b"!")), of_words(lambda w: sum(b in SYMBOLS for b in w) >= 2),
        of_words(lambda w: w == b"|"), of_words(lambda w: w.endswith(b".")),
        sum(a == b for a, b in zip(low, low[1:])) / n, len(set(low)) / n,
        sum(len(set(p)) / len(p) for p in windows) / len(windows), math.log1p(len(lines)),
        math.log1p(size / len(lines)), sum(p.rstrip()[-1:] in b".!?:\"" for p in lines) / len(lines),
        1 - len(set(lines)) / len(lines), of_words(lambda w: 65 <= w[0] <= 90)]


def test_features_word_by_word():
    rnd = random.Random(3)
    pieces = ["word", "Word", "go!", "|", "a|b|c", "x.", "é漢", "12", "\n", "\n\n", "\t", "end:\n", "w" * 25, "the the"]
    texts = [" ".join(rnd.choice(pieces) for _ in range(n)) for n in (1, 2, 30, 199, 450, 3000)]
    texts += ["", None, " \n ", "same\nsame\nsame.", "one"]
    got = features.style(pa.array(texts))
    for name, column, want in zip(features.NAMES, got.T, zip(*map(plain, texts))):
        np.testing.assert_allclose(column, want, atol=1e-12, err_msg=name)


def all_pairs(z: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """The least logistic loss over every (1, 0) pair, by plain gradient descent."""
    d = (z[y == 1][:, None, :] - z[y == 0][None, :, :]).reshape(-1, z.shape[1])
    w = np.zeros(z.shape[1])
    rate = 1 / (np.linalg.norm(d.T @ d / len(d), 2) / 4 + ridge)
    for _ in range(20_000):
        w += rate * (d.T @ (1 / (1 + np.exp(d @ w))) / len(d) - ridge * w)
    return w


def test_fit_is_the_optimum_over_all_pairs():
    rng = np.random.default_rng(8)
    y = (rng.random(60) < 0.6).astype(int)
    x = rng.normal(0, 1, (60, 3)) + y[:, None] * [1.0, -0.5, 0.0]
    ranking = pairwise_rank.fit(x, y, float(np.mean(y == 0)), 1_000_000, 1e-2)
    z = (x - x.mean(0)) / (x.std(0) + 1e-6)
    np.testing.assert_allclose(ranking.weights, all_pairs(z, y, 1e-2), atol=0.02)
    raw = np.sort(z @ ranking.weights)
    zeros = int(np.sum(y == 0))
    assert raw[zeros - 1] <= ranking.cut + 1e-9 and ranking.cut <= raw[zeros] + 1e-9     # as many below as zeros


def test_query_scores_by_definition(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter(held_out("doc_id", 5) != 0)
    r = pairwise_rank.learn(docs, labels)
    got = {row.doc_id: row.score for row in queries.op4_pairwise_rank(spark, SF).collect()}
    for row in docs.collect():
        z = np.clip((np.array(plain(row.text)) - r.mean) / r.scale, -8, 8) @ r.weights
        odds = (z - r.cut) / r.spread + math.log(0.3 / 0.7)
        assert math.isclose(got[row.doc_id], 1 / (1 + math.exp(-max(-30, min(30, odds)))), abs_tol=1e-9)
