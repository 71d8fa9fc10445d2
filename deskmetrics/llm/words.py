"""Vectorised word splitting and hashing over Arrow string columns.

A batch of texts is one UTF-8 buffer with row offsets.  Word borders, ASCII
lower-casing, 64-bit word hashes and hashes of word windows are computed by
whole-array numpy operations; there is no Python loop over words.  Two
different words (or windows) of a corpus get the same 64-bit hash with a
probability of about n^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Texts are handled in runs of rows of about this many bytes.
RUN_BYTES = 1 << 20

_U = np.uint64
_R = 0x9E3779B97F4A7C15 | 1
_RINV = pow(_R, -1, 1 << 64)


def _byte_codes(lower: bool) -> np.ndarray:
    codes = np.random.default_rng(20240229).integers(0, 1 << 64, 256, dtype=np.uint64) | _U(1)
    if lower:
        codes[65:91] = codes[97:123]
    return codes


_CODES = {flag: _byte_codes(flag) for flag in (False, True)}
#: Bytes that end a word: ASCII white space, or every ASCII non-alphanumeric.
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
NOT_ITEM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """r^0..r^n and r^-0..r^-n modulo 2^64; only the common size is kept."""
    size = max(n, RUN_BYTES) + 1
    if size in _powers:
        return _powers[size]
    made = []
    for base in (_R, _RINV):
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        made.append(np.multiply.accumulate(steps))
    if size == RUN_BYTES + 1:
        _powers[size] = tuple(made)
    return tuple(made)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (the splitmix64 finaliser)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """One uint64 per span of bytes, equal for equal bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, inverse = _power_tables(len(buf))
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_CODES[lower][buf] * power[:len(buf)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """Words of a run of rows: byte borders in ``buf`` and the first word of each row."""
    buf: np.ndarray
    rows: np.ndarray      # byte offset of each row, one more than rows
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray     # index of each row's first word, one more than rows

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lower: bool = True) -> np.ndarray:
        """One uint64 per word."""
        return span_hashes(self.buf, self.starts, self.ends, lower)

    def windows(self, h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``width`` words and the first window of each row."""
        n = np.maximum(self.counts - (width - 1), 0)
        first = np.concatenate([[0], np.cumsum(n)])
        total = max(len(h) - width + 1, 0)
        acc = np.zeros(total, np.uint64)
        for j in range(width):
            acc = acc * _U(_R) + h[j:j + total]
        at = np.arange(first[-1]) + np.repeat(self.first[:-1] - first[:-1], n)
        return mix(acc[at]), first

    def text(self, i: int) -> str:
        return self.buf[self.starts[i]:self.ends[i]].tobytes().decode()


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    arr = texts.cast(pa.large_string()).fill_null("")
    if arr.offset or not len(arr):
        arr = pa.concat_arrays([arr])
    offsets = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1] \
        if len(arr) else np.zeros(1, np.int64)
    data = arr.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def runs(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, row offsets) for runs of about RUN_BYTES."""
    buf, offsets = _flat(texts)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + RUN_BYTES, "right")) - 1)
        yield lo, hi, buf[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def split(buf: np.ndarray, rows: np.ndarray, stop: np.ndarray = SPACE) -> Words:
    """Words of the rows: maximal runs of bytes outside ``stop`` (NULL has none)."""
    inside = ~stop[buf]
    begin, end = inside.copy(), inside.copy()
    border = rows[(rows > 0) & (rows < len(buf))]
    joined = inside[1:] & inside[:-1]      # byte i+1 goes on with the word of byte i
    joined[border - 1] = False
    begin[1:] &= ~joined
    end[:-1] &= ~joined
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return Words(buf, rows, starts, ends, np.searchsorted(starts, rows))


def run_words(texts: pa.Array, stop: np.ndarray = SPACE) -> Iterator[tuple[int, int, Words]]:
    for lo, hi, buf, rows in runs(texts):
        yield lo, hi, split(buf, rows, stop)
