from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from deskmetrics.llm import words as W

from . import brute

text = st.text(alphabet=" \t\n\r\x0b\x0c\x1c\x85\xa0aAbZ09é漢-!\U0001F600", max_size=30)
rows = st.lists(st.one_of(st.none(), text), max_size=8)


def _split(texts, stop):
    out = []
    for _, _, w in W.run_words(pa.array(texts, pa.string()), stop):
        out += [[w.text(i) for i in range(w.first[r], w.first[r + 1])] for r in range(len(w.counts))]
    return out


@given(rows)
def test_words_are_those_of_the_expressions(texts):
    assert _split(texts, W.SPACE) == [brute.words(t) for t in texts]
    lowered = [[brute.lower(x) for x in r] for r in _split(texts, W.NOT_ITEM)]
    assert lowered == [brute.item_words(t) for t in texts]


@given(rows)
def test_hashes_tell_words_and_windows_apart(texts):
    seen, grams = {}, {}
    for lo, hi, w in W.run_words(pa.array(texts, pa.string())):
        h = w.hashes()
        hashes, first = w.windows(h, 2)
        for r, t in enumerate(texts[lo:hi]):
            own = brute.words(brute.lower(t or ""))
            assert len(own) == w.counts[r]
            for x, y in zip(own, h[w.first[r]:w.first[r + 1]].tolist()):
                assert seen.setdefault(x, y) == y
            pairs = list(zip(own, own[1:]))
            assert len(pairs) == first[r + 1] - first[r]
            for x, y in zip(pairs, hashes[first[r]:first[r + 1]].tolist()):
                assert grams.setdefault(x, y) == y
    assert len(set(seen.values())) == len(seen) and len(set(grams.values())) == len(grams)


def test_runs_cover_rows_and_a_row_may_be_longer_than_a_run():
    texts = ["a b " * 10, "c" * (W.RUN_BYTES + 10), None, "d e"]
    parts = [(lo, hi, w.counts.tolist()) for lo, hi, w in W.run_words(pa.array(texts))]
    assert [p[:2] for p in parts][0][0] == 0 and parts[-1][1] == 4
    assert [n for p in parts for n in p[2]] == [20, 1, 0, 2]


def test_sliced_arrays():
    arr = pa.array(["x", "one two", None, "three"]).slice(1, 3)
    assert [w.counts.tolist() for _, _, w in W.run_words(arr)] == [[2, 0, 1]]
    assert np.concatenate([w.hashes() for _, _, w in W.run_words(arr)]).size == 3
