from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from deskmetrics.llm import features


def windowed(words):
    """Mean share of distinct words of consecutive windows, by definition."""
    parts = [words[i:i + features.WINDOW] for i in range(0, len(words), features.WINDOW)]
    return sum(len(set(p)) / len(p) for p in parts) / len(parts) if parts else 0.0


def test_distinct_words_are_measured_over_the_whole_text():
    rnd = random.Random(1)
    texts = [" ".join(f"w{rnd.randrange(60)}" for _ in range(n)) for n in (1, 7, 199, 200, 201, 650, 4000)]
    texts += ["", None, "one " * 450 + " ".join(f"x{i}" for i in range(350))]
    at = features.NAMES.index("distinct_of_windows")
    want = [windowed((t or "").split()) for t in texts]
    np.testing.assert_allclose(features.style(pa.array(texts))[:, at], want)


def test_stems_are_first_bytes():
    (*_, words, stems), = features.word_buckets(pa.array(["Walking walkingly walk talk WALKIN"]))
    assert len(set(stems[[0, 1, 4]].tolist())) == 1 and len(set(stems.tolist())) == 3
    assert len(set(words.tolist())) == 5 and stems.min() >= features.BUCKETS > words.max()
