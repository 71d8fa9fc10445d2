from __future__ import annotations

import random

from pyspark.sql import functions as F

from deskmetrics.llm import line_dedup, queries

from . import brute
from .conftest import SF


def verdicts(rows: list[tuple], num: int = 4, den: int = 5) -> list[list[int]]:
    """Removed line numbers of each (doc_id, text), comparing with all earlier lines."""
    seen: list[frozenset] = []
    out = {}
    for i in sorted(range(len(rows)), key=lambda i: rows[i][0]):
        gone = []
        for k, line in enumerate((rows[i][1] or "").split("\n")):
            w = frozenset(brute.words(brute.lower(line)))
            if w and any(den * len(w & s) >= num * len(w | s) for s in seen):
                gone.append(k)
            if w:
                seen.append(w)
        out[i] = gone
    return [out[i] for i in range(len(rows))]


def test_query_matches_brute_force(spark, sf_texts):
    keys = sorted(sf_texts)
    want = verdicts([(k, sf_texts[k]) for k in keys])
    got = {r.doc_id: (r.n_lines, r.n_removed, r.removed) for r in queries.op10_line_dedup(spark, SF).collect()}
    lines = lambda t: sum(bool(brute.words(x)) for x in (t or "").split("\n"))
    assert got == {k: (lines(sf_texts[k]), len(g), ",".join(map(str, g))) for k, g in zip(keys, want)}


def test_no_python_on_the_main_path(spark):
    plan = queries.op10_line_dedup(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_near_copies_around_the_threshold(spark):
    rnd = random.Random(8)
    base = [f"b{i}" for i in range(24)]

    def line():
        words = list(base[:rnd.choice((1, 2, 5, 9, 10, 18, 24))])
        for _ in range(rnd.randrange(0, 5)):
            words[rnd.randrange(len(words))] = f"r{rnd.randrange(30)}"
        rnd.shuffle(words)
        return " ".join(w.upper() if rnd.random() < 0.2 else w for w in words)
    rows = [(i, "\n".join(line() for _ in range(rnd.randrange(1, 6)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for num, den in ((4, 5), (1, 2)):
        got = {r.doc_id: r.removed for r in line_dedup.by_document(docs, num=num, den=den).collect()}
        assert got == dict(zip(range(60), verdicts(rows, num, den)))


def test_long_lines_and_lines_of_one_document(spark):
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(160)]

    def line():
        words = base[:rnd.choice((60, 63, 64, 65, 70, 150, 160))]
        for _ in range(rnd.randrange(0, len(words) // 7)):
            words[rnd.randrange(len(words))] = f"r{rnd.randrange(400)}"
        return " ".join(rnd.sample(words, len(words)))
    rows = [(i, "\n".join(line() for _ in range(rnd.randrange(1, 9)))) for i in range(25)]
    got = {r.doc_id: r.removed for r in line_dedup.by_document(
        spark.createDataFrame([(str(i + 10), t) for i, t in rows], "doc_id string, text string")).collect()}
    assert got == {str(i + 10): gone for (i, _), gone in zip(rows, verdicts(rows))}


def test_texts_are_split_once_before_lines_are_compared(spark, monkeypatch):
    steps, stage = {}, line_dedup.staged

    def seen(df, what, **kwargs):
        if "split(" in df._jdf.queryExecution().analyzed().toString():
            steps[what] = steps.get(what, 0) + 1
        return stage(df, what, **kwargs)
    monkeypatch.setattr(line_dedup, "staged", seen)
    docs = spark.createDataFrame([(1, "a b c\nd e"), (2, "c b a"), (3, "d e")], "doc_id long, text string")
    assert {r.doc_id: r.removed for r in line_dedup.by_document(docs).collect()} == {1: [], 2: [0], 3: [0]}
    # the words of all lines once, and those of the lines to compare at each of two comparisons
    assert steps == {"hashes": 1, "words": 2}


def test_a_run_of_shared_words_is_one_meeting(spark):
    rows = [(1, 10, 9, 0, [7, 3, 5, 4]), (2, 20, 9, 0, [7, 3, 5, 4]), (3, 30, 9, 0, [8, 3, 5, 6])]
    classes = spark.createDataFrame(rows, "lid long, id long, n int, sig long, prefix array<int>") \
        .withColumn("half", F.lit(None).cast("long"))
    # the first two share four words in a row; the third shares two with each, after another word
    met = sorted((r.lid, r.other) for r in line_dedup._meetings(line_dedup._tokens(classes), 1, 2).collect())
    assert met == [(2, 1), (3, 1), (3, 2)]


def test_white_space_inside_lines(spark):
    docs = spark.createDataFrame([(1, "a\tb\x0bc d\n \t\n\x0c"), (2, "\rD  C b\fA\n\u00c4 \u00a0"), (3, "\u00e4 \u00a0\n\u00c4\t\u00a0 ")],
                                 "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, r.removed) for r in line_dedup.by_document(docs).collect()}
    assert got == {1: (1, []), 2: (2, [0]), 3: (2, [1])}


def test_edge_rows(edge_docs, edge_rows, clashing_docs, no_docs):
    rows = line_dedup.by_document(edge_docs).collect()
    assert len(rows) == len(edge_rows)
    got = {r.doc_id: (r.n_lines, r.removed) for r in rows if r.doc_id is not None}
    assert got[1] == (1, []) and got[2] == got[3] == (1, [0]) and got[13] == (1, [2])
    assert got[4] == got[5] == got[6] == (0, []) and got[8] == (1, []) and got[9] == (1, [0])
    assert got[15] == (6, [1, 2, 3, 4, 5]) and got[10][0] == 3000
    cleaned = line_dedup.dedup(clashing_docs)
    assert cleaned.columns == clashing_docs.columns
    texts = {r.doc_id: r.text for r in cleaned.collect() if r.doc_id is not None}
    assert texts[2] == "" and texts[4] is None and texts[5] == "" and texts[6] == " \t\n "
    assert texts[15] == "same line here now\n" and texts[13] == "\n\n"
    assert line_dedup.by_document(no_docs).collect() == [] == line_dedup.dedup(no_docs).collect()
