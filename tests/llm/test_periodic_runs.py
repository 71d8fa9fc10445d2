from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from deskmetrics.llm import periodic_runs, queries

from . import brute
from .conftest import SF


def plain_runs(s, exponent, least):
    """All runs by comparing places, period by period."""
    found = set()
    for q in range(1, len(s) // exponent + 1):
        i = 0
        while i + q < len(s):
            if s[i] != s[i + q]:
                i += 1
                continue
            begin = i
            while i + q < len(s) and s[i] == s[i + q]:
                i += 1
            end = i + q
            smaller = any(all(s[x] == s[x + r] for x in range(begin, end - r)) for r in range(1, q))
            if end - begin >= max(least, exponent * q) and not smaller:
                found.add((begin, end - begin, q))
            i += 1
    return found


def sequences(n):
    rnd = random.Random(5)
    for _ in range(n):
        k, s = rnd.randint(1, 4), []
        while len(s) < rnd.randint(0, 30):
            s += [rnd.randrange(k) for _ in range(rnd.randint(1, 5))] * rnd.choice([1, 1, 2, 4, 5])
        code = {v: i for i, v in enumerate(sorted(set(s)))}
        yield [code[v] for v in s]


def test_lyndon_array_by_definition():
    for s in sequences(1500):
        for i, n in enumerate(periodic_runs.lyndon_array(s)):
            j = i + 1
            while j < len(s) and s[j:] > s[i:]:
                j += 1
            assert n == j - i, s


@pytest.mark.parametrize(("exponent", "least"), [(2, 0), (3, 0), (4, 6), (5, 12)])
def test_runs_match_brute_force(exponent, least):
    for s in sequences(1500):
        assert periodic_runs.runs_of(s, exponent, least) == plain_runs(s, exponent, least), s
        words = [f"w{v}" for v in s]
        assert set(periodic_runs.word_runs(words, exponent, least)) == plain_runs(s, exponent, least), s


def test_long_periodic_texts_stay_linear():
    assert periodic_runs.word_runs(["a"] * 200_000) == [(0, 200_000, 1)]
    assert periodic_runs.word_runs(["x", *["a", "b", "a"] * 50_000, "y"]) == [(1, 150_000, 3)]


def tailed(doc_id, text):
    """Words with the contract's periodic tail."""
    w = brute.words(text)
    h = brute.crc(doc_id if doc_id is not None else "")
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + math.floor((n - a) / (3 + g % 8))
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    w = tailed(doc_id, text)
    runs = sorted(plain_runs(w, 4, 6), key=lambda r: (r[0], r[2]))
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (len(runs), *best, brute.sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)),
            brute.sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def row_of(r):
    return (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)


def test_query_matches_brute_force(spark, sf_texts):
    rows = {r.doc_id: row_of(r) for r in queries.op13_periodic_runs(spark, SF).collect()}
    assert rows.keys() == sf_texts.keys()
    short = {k: t for k, t in sf_texts.items() if len(t or "") < 12_000}
    assert len(short) > 100 and sum(rows[k][0] > 0 for k in short) > 10
    for k, t in short.items():
        assert rows[k] == expected(k, t), k


def test_edge_rows(edge_docs, edge_rows, clashing_docs, no_docs):
    found = periodic_runs.find(edge_docs)
    by_id = {r.doc_id: r for r in found.collect()}
    assert found.count() == len(edge_rows)
    assert (by_id[4].n_words, by_id[4].runs, by_id[4].collapsed) == (0, [], "")
    assert by_id[5].n_words == by_id[6].n_words == 0 and by_id[7].collapsed == "one"
    assert [tuple(r) for r in by_id[15].runs] == [(0, 24, 4)] and by_id[15].collapsed == "same line here now"
    assert by_id[10].n_words == 120_000
    out = periodic_runs.find(periodic_runs.with_tails(clashing_docs.withColumn("runs", F.lit(1))))
    assert out.columns.count("runs") == 1 and out.columns.count("n") == 1 and out.count() == len(edge_rows)
    assert periodic_runs.find(periodic_runs.with_tails(no_docs)).collect() == []


def test_tails(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(i % 40)) if i % 7 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in periodic_runs.with_tails(df).collect():
        assert (r.text or "").split() == tailed(r.doc_id, dict(rows)[r.doc_id])
