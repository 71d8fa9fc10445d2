from __future__ import annotations

import pytest

from deskmetrics.llm import queries, quality_rules

from . import brute
from .conftest import CLASHING, SF, prose

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def _base(rows):
    return {r.doc_id: tuple(r[c] for c in BASE) for r in rows}


def test_base_columns_match_brute_force(spark, sf_texts):
    rows = queries.op9_quality_rules(spark, SF).collect()
    assert _base(rows) == {k: brute.base_rules(t) for k, t in sf_texts.items()}
    assert not any(r.kept and r.base_failed for r in rows)


def test_edge_rows(edge_docs, edge_rows):
    rows = quality_rules.judge(edge_docs).collect()
    assert len(rows) == len(edge_rows)
    for r in rows:
        assert tuple(r[c] for c in BASE) == brute.base_rules(r.text)
    assert not any(r.kept for r in rows if not r.text)


@pytest.mark.parametrize("line", [
    "Home | News | Sport | Contact", "ALL OF THIS!! IS!! SHOUTED!! AT!! YOU!! AND!! MORE!! OF!! IT!!",
    "word### other*** third$$$ plain", "go go go go go go go go on", " ".join(f"w{i}" for i in range(50))])
def test_failing_lines_go(spark, line):
    good = "\n".join(prose(i, 25, 10**6) for i in range(6))
    docs = spark.createDataFrame([(1, f"{good}\n{line}", 0), (2, f"{line}\n" * 1 + "short one.", 0), (3, good, 7)],
                                 "doc_id long, text string, n_chars int")
    kept = {r.doc_id: r for r in quality_rules.clean(docs).collect()}
    assert set(kept) == {1, 3} and kept[1].text == good == kept[3].text and kept[1].n_chars == len(good)


def test_repeated_lines_go_and_losing_much_rejects(spark):
    lines = [prose(i, 10, 10**6) for i in range(10)]
    docs = spark.createDataFrame([(1, "\n".join([*lines, lines[0], "", ""])), (2, "\n".join(lines[:3] * 3))],
                                 "doc_id long, text string")
    kept = quality_rules.clean(docs).collect()
    assert [(r.doc_id, r.text) for r in kept] == [(1, "\n".join([*lines, "", ""]))]


def test_clashing_names_and_empty_table(clashing_docs, edge_docs, no_docs):
    out = quality_rules.clean(clashing_docs)
    assert out.columns == clashing_docs.columns
    ids = lambda df: sorted(r.doc_id or 0 for r in df.collect())
    assert ids(out) == ids(quality_rules.clean(edge_docs))
    judged = quality_rules.judge(clashing_docs)
    assert set(CLASHING) <= set(judged.columns) and judged.columns.count("kept") == 1
    assert quality_rules.judge(no_docs).collect() == [] == quality_rules.clean(no_docs).collect()


@pytest.mark.parametrize("line", [
    "All rights reserved.", "Released under the MIT License.", "Licensed under CC BY-NC 4.0.",
    "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3.",
    "Copyright (c) 2021 Some Body. All rights reserved.", "© 2020 Example Ltd", "We use cookies to improve your visit.",
    "Accept all cookies", "Subscribe to our weekly newsletter!", "Sign up now", "Terms of Use and Privacy Policy",
    "By using this site you agree to our Terms of Service.", "Home > News > Sport", "start » news » sport",
    "• Home • News • Contact", "[Home](/) [News](/n) [Contact](/c)"])
def test_notices_and_trails_go(spark, line):
    good = "\n".join(prose(i, 25, 10**6) for i in range(6))
    docs = spark.createDataFrame([(1, f"{line}\n{good}\n{line.upper() if line.isascii() else line}")], "doc_id long, text string")
    if line.startswith(("Home >", "[Home]")):
        docs = spark.createDataFrame([(1, f"{good}\n{line}")], "doc_id long, text string")
    assert [r.text for r in quality_rules.clean(docs).collect()] == [good]


def test_prose_about_notices_stays(spark):
    lines = ["The court held that all rights reserved to the states were theirs to keep.",
             "He was licensed under protest and later drove a taxi in the old town.", "Copyright law was changed in 1976.",
             "Cookies are baked for twelve minutes, and we use butter.", "She had to sign up for the army to see the world.",
             "Subscribe is a verb.", "The terms of use were argued over for a year.", "• one point of a list that stays",
             "If a > b and b > c then a > c.", "Released under the bridge, the boats drifted off.",
             "By using a lever he moved the stone.", "Register to vote before the end of the month."]
    text = "\n".join(lines)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [r.text for r in quality_rules.clean(docs).collect()] == [text]
