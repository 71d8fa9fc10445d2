"""Fixed-length numeric descriptions of texts, computed over whole-batch
arrays.  Nothing but the text goes in."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from . import words as W

#: Buckets of the hashed words, and as many again of the hashed stems.
BUCKETS = 1 << 16
#: Bytes of a word that make its stem.
STEM = 6
#: Words of a window of ``distinct_of_windows``.
WINDOW = 200

NAMES = ("log_words", "word_length", "long_words", "upper_share", "digit_share", "symbol_share", "mark_share",
         "other_share", "non_ascii_share", "shout_words", "symbol_words", "bar_words", "stop_words",
         "stutter_share", "distinct_share", "distinct_of_windows", "log_lines", "line_length", "line_stop_share",
         "repeat_lines", "capital_words")

_ids = np.arange(256)
_UPPER, _DIGIT = (_ids >= 65) & (_ids <= 90), (_ids >= 48) & (_ids <= 57)
_SYMBOL = np.isin(_ids, list(b"#*$%&|<>{}[]\\^~_=+/@"))
_MARK = np.isin(_ids, list(b".,;:!?'\"()-"))
_OTHER = (_ids < 32) & (_ids != 10)


def _per_row(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(flags)])
    return total[first[1:]] - total[first[:-1]]


def _windowed_distinct(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mean share of distinct words over all consecutive ``WINDOW``-word
    windows of each text (the last one may be shorter)."""
    n = np.diff(first)
    row = np.repeat(np.arange(len(n)), n)
    blocks = -(-n // WINDOW)
    block = np.concatenate([[0], np.cumsum(blocks)])[row] + (np.arange(len(h)) - first[row]) // WINDOW
    order = np.lexsort((h, block))
    b, v = block[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (b[1:] != b[:-1]) | (v[1:] != v[:-1])
    total = int(blocks.sum())
    share = np.bincount(b[new], minlength=total) / np.maximum(np.bincount(block, minlength=total), 1)
    owner = np.repeat(np.arange(len(n)), blocks)
    return np.bincount(owner, share, minlength=len(n)) / np.maximum(blocks, 1)


def _run_features(buf: np.ndarray, rows: np.ndarray, w: W.Words, h: np.ndarray) -> np.ndarray:
    n_rows = len(rows) - 1
    n, size = w.counts, np.diff(rows)
    per_word, per_byte = 1.0 / np.maximum(n, 1), 1.0 / np.maximum(size, 1)
    length = w.ends - w.starts
    byte = lambda table: _per_row(table[buf], rows) * per_byte
    word = lambda flags: _per_row(flags, w.first) * per_word
    first_byte = buf[w.starts] if len(w.starts) else np.zeros(0, np.uint8)
    last_byte = buf[w.ends - 1] if len(w.starts) else np.zeros(0, np.uint8)
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[buf])])
    stutter = np.zeros(len(h), bool)
    stutter[1:] = h[1:] == h[:-1]
    stutter[w.first[w.first < len(h)]] = False
    distinct = np.zeros(n_rows)
    windowed = _windowed_distinct(h, w.first)
    repeat_lines, lines, stops = np.zeros(n_rows), np.zeros(n_rows), np.zeros(n_rows)
    for r in range(n_rows):
        a, b = w.first[r], w.first[r + 1]
        distinct[r] = len(np.unique(h[a:b])) / max(b - a, 1)
        parts = [p for p in buf[rows[r]:rows[r + 1]].tobytes().split(b"\n") if p.strip()]
        lines[r] = len(parts)
        repeat_lines[r] = 1 - len(set(parts)) / max(len(parts), 1)
        stops[r] = sum(p.rstrip()[-1:] in b".!?:\"" for p in parts) / max(len(parts), 1)
    return np.stack([
        np.log1p(n), word(length) / 10, word(length > 20), byte(_UPPER), byte(_DIGIT), byte(_SYMBOL),
        byte(_MARK), byte(_OTHER), byte(_ids >= 128), word(last_byte == 33),
        word(symbols[w.ends] - symbols[w.starts] >= 2), word((length == 1) & (first_byte == 124)),
        word(last_byte == 46), word(stutter), distinct, windowed, np.log1p(lines),
        np.log1p(size / np.maximum(lines, 1)), stops, repeat_lines,
        word(_UPPER[first_byte] if len(first_byte) else first_byte),
    ], 1).astype(np.float64)


def style(texts: pa.Array) -> np.ndarray:
    """One row of NAMES per text; zeros for a text without words."""
    out = []
    for _, _, w in W.run_words(texts):
        table = _run_features(w.buf, w.rows, w, w.hashes())
        table[w.counts == 0] = 0.0
        out.append(table)
    return np.concatenate(out) if out else np.zeros((0, len(NAMES)))


def word_buckets(texts: pa.Array):
    """(first word of each row, bucket of each word, of each word's stem) for
    runs of rows."""
    for lo, hi, w in W.run_words(texts):
        stems = W.span_hashes(w.buf, w.starts, np.minimum(w.ends, w.starts + STEM), lower=True)
        yield (lo, hi, w.first, (w.hashes() % np.uint64(BUCKETS)).astype(np.int32),
               BUCKETS + (stems % np.uint64(BUCKETS)).astype(np.int32))
