"""Line-first cleaning (quality rules).

Each line of a text is judged by itself; lines that break a rule are removed;
a document that loses too much of its text, or that fails the base rules on
the whole text, is rejected.

Line rules (a line without a word is neutral and stays):

* navigation: at least ``min_bars`` words are a bare ``|`` separator, or the
  line is nothing but three or more short pieces between ``»``, ``›``, ``→`` or
  ``•`` (or capitalised pieces between ``>``, ``/`` or ``·``), or nothing but
  three or more Markdown links;
* shouting: no lower-case ASCII letter, at least ``min_line_words`` words, and
  at least half of the words end in ``!``;
* symbols: more than ``max_symbol_words`` of the words hold a run of two or
  more of the characters ``#*$%&|<>``;
* punctuation: at least ``long_line_words`` words and neither an ASCII
  punctuation mark nor a non-ASCII character;
* boilerplate: at most ``max_notice_words`` words, and a license, copyright,
  cookie, sign-up or terms notice by the phrases of ``NOTICES``; they are tied
  to the start or end of the line, so prose about such things stays;
* stuttering: at least ``min_line_words`` words, and more than
  ``max_repeat_words`` of them equal the word before;
* the same line, with a word, was seen before in the text.

Base rules (whole text): fewer than 20 words, or over 30 % of the words in
8-word windows that occur twice or more.

Defined results: a NULL or empty text has no words, fails the base rules and
is rejected; repeated rows are judged alike, each by itself; any further
columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructType

from . import words as W
from .common import per_batch, undotted, without

WINDOW = 8
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_MARK = np.array([b >= 128 or (b > 32 and not chr(b).isalnum()) for b in range(256)])

#: Phrases of notices, by kind; a line is matched from its start, after marks.
NOTICES = {
    "license": r"(?:(?:this|the) (?:work|software|program|code|file|text|content|document|article|page|site|website)"
               r" (?:is|are) (?:also )?(?:licen[sc]ed|released|distributed|made available) under\b"
               r"|(?:dual.)?(?:licen[sc]ed|released|distributed|published|available) under (?=.*(?:licen[sc]e|\bcc\b|mit\b|gpl|apache|creative commons))"
               r"(?:the |an? |cc\b|mit\b|gpl|apache)"
               r"|spdx-license-identifier:)",
    "copyright": r"(?:(?:copyright|copr\.) ?(?:©|\(c\)|\d{4}|by )|(?:©|\(c\)) ?\d{4}|all rights reserved\W*$"
                 r"|(?:copyright|©|\(c\)|\d{4}).{0,120}\ball rights reserved\W*$)",
    "cookie": r"(?:(?:this|our) (?:web ?)?site uses (?:\w+ )?cookies|we use (?:\w+ )?cookies"
              r"|(?:accept|reject|allow|manage) (?:all )?cookies\W*$|cookie (?:policy|settings|preferences|notice)\W*$"
              r"|by (?:continuing|using|browsing|visiting).{1,120}\bcookies\b)",
    "sign-up": r"(?:(?:sign up|subscribe|register|sign in|log ?in)\W*(?:$|(?:now|today|here|free)\W*$"
               r"|(?:(?:now|today|here) )?(?:for|to) (?:our|the|your|a free|free|get|receive|continue|read)\b.{0,80}"
               r"(?:newsletters?|updates|mailing list|account|e-?mails?|offers|alerts|reading|inbox)\b)"
               r"|(?:join|get) our (?:\w+ )?(?:newsletter|mailing list))",
    "terms": r"(?:(?:terms (?:of (?:use|service)|(?:and|&) conditions)|privacy (?:policy|notice))"
             r"(?:\W+(?:and|&)?\W*(?:terms (?:of (?:use|service)|(?:and|&) conditions)|privacy (?:policy|notice)|cookie policy))*\W*$"
             r"|by (?:using|continuing|signing|accessing|clicking|registering|subscribing).{1,120}\b(?:agree|accept|consent)\b"
             r".{0,80}\b(?:terms|conditions|privacy policy)\b)",
}
_NOTICE = re.compile(r"[\s*#>•·–—-]*(?:" + "|".join(NOTICES.values()) + ")", re.I)
_TRAIL = re.compile(r"\s*(?:[»›→•]\s+)?[^»›→•|]{1,40}(?:\s[»›→•]\s+[^»›→•|]{1,40}){2,}\s*$"
                    r"|\s*[A-Z][^>/·|]{0,39}(?:\s([>/·])\s+[A-Z][^>/·|]{0,39})(?:\s\1\s+[A-Z][^>/·|]{0,39})+\s*$"
                    r"|(?:[\s|»›→•·,-]*\[[^\]]{1,40}\]\([^)\s]*\)){3,}[\s|»›→•·,-]*$")


@dataclass(frozen=True)
class Rules:
    min_words: int = 20
    max_repeat_share: float = 0.3
    max_lost_share: float = 0.3     # of the characters in words
    min_bars: int = 3
    min_line_words: int = 8
    long_line_words: int = 40
    max_symbol_words: float = 0.3
    max_repeat_words: float = 0.3
    max_notice_words: int = 40


def _repeated_words(hashes: np.ndarray, n_words: int) -> int:
    """Words inside windows whose hash occurs at least twice."""
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(hashes), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    change = np.zeros(n_words + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(change)[:-1]))


def _sum(flags: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` over [lo, hi)."""
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[hi] - total[lo]


@dataclass
class _Lines:
    """Line borders (bytes, and words) of a run of rows; every row has a line."""
    lo: np.ndarray
    hi: np.ndarray
    first: np.ndarray     # index of each row's first line, one more than rows
    w_lo: np.ndarray
    w_hi: np.ndarray


def _lines(buf: np.ndarray, rows: np.ndarray, w: W.Words) -> _Lines:
    feeds = np.flatnonzero(buf == 10)
    n_rows = len(rows) - 1
    owner = np.concatenate([np.arange(n_rows), np.searchsorted(rows, feeds, "right") - 1])
    order = np.argsort(owner, kind="stable")      # a row's own start, then its line feeds
    owner = owner[order]
    lo = np.concatenate([rows[:-1], feeds + 1])[order]
    hi = np.empty_like(lo)
    hi[:-1] = lo[1:] - 1
    first = np.searchsorted(owner, np.arange(n_rows + 1))
    hi[first[1:] - 1] = rows[1:]
    return _Lines(lo, hi, first, np.searchsorted(w.starts, lo), np.searchsorted(w.starts, hi))


def _bad_lines(buf: np.ndarray, w: W.Words, h: np.ndarray, lines: _Lines,
               rules: Rules) -> np.ndarray:
    lo, hi = lines.w_lo, lines.w_hi
    n = hi - lo
    bars = _sum((w.ends - w.starts == 1) & (buf[w.starts] == 124), lo, hi)
    shouts = _sum(buf[w.ends - 1] == 33, lo, hi)
    lower = _sum((buf >= 97) & (buf <= 122), lines.lo, lines.hi)
    marks = _sum(_MARK[buf], lines.lo, lines.hi)
    pair = np.zeros(len(buf), bool)
    pair[1:] = _SYMBOL[buf[1:]] & _SYMBOL[buf[:-1]]
    pairs = np.concatenate([[0], np.cumsum(pair)])
    symbols = _sum(pairs[w.ends] > pairs[w.starts + 1], lo, hi)
    stutter = np.zeros(len(h), bool)
    stutter[1:] = h[1:] == h[:-1]
    stutter[w.first[w.first < len(h)]] = False
    stutters = _sum(stutter, lo, hi)
    return (bars >= rules.min_bars) \
        | ((n >= rules.min_line_words) & (lower == 0) & (2 * shouts >= n)) \
        | ((n > 0) & (symbols > rules.max_symbol_words * n)) \
        | ((n >= rules.long_line_words) & (marks == 0)) \
        | ((n >= rules.min_line_words) & (stutters > rules.max_repeat_words * n))


def _is_notice(raw: bytes, n_words: int, rules: Rules) -> bool:
    """A boilerplate notice, a trail of short pieces or a run of links."""
    if not 0 < n_words <= rules.max_notice_words:
        return False
    line = raw.decode()
    return bool(_NOTICE.match(line) or _TRAIL.match(line))


def _judge(buf: np.ndarray, rows: np.ndarray, rules: Rules) -> Iterator[tuple]:
    """One tuple in the order of ``ADDED`` for each row."""
    w = W.split(buf, rows)
    h = w.hashes(lower=False)
    windows, first_window = w.windows(h, WINDOW)
    points = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])  # before each byte
    chars = np.concatenate([[0], np.cumsum(points[w.ends] - points[w.starts])])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[buf])])
    lines = _lines(buf, rows, w)
    bad = _bad_lines(buf, w, h, lines, rules)
    max_repeat = round(100 * rules.max_repeat_share)
    for r in range(len(rows) - 1):
        n_words = int(w.first[r + 1] - w.first[r])
        seen: set[bytes] = set()
        kept_lines, n_dup, lost, n_lost = [], 0, 0, 0
        for i in range(lines.first[r], lines.first[r + 1]):
            raw = buf[lines.lo[i]:lines.hi[i]].tobytes()
            again = lines.w_hi[i] > lines.w_lo[i] and raw in seen
            seen.add(raw)
            n_dup += bool(again)
            if again or bad[i] or _is_notice(raw, int(lines.w_hi[i] - lines.w_lo[i]), rules):
                lost += int(chars[lines.w_hi[i]] - chars[lines.w_lo[i]])
                n_lost += 1
            else:
                kept_lines.append(raw)
        word_chars = int(chars[w.first[r + 1]] - chars[w.first[r]])
        repeats = _repeated_words(windows[first_window[r]:first_window[r + 1]], n_words)
        failed = n_words < rules.min_words or 100 * repeats > max_repeat * n_words
        yield (n_words, word_chars, int(symbols[rows[r + 1]] - symbols[rows[r]]), n_dup, repeats,
               failed, not failed and lost <= rules.max_lost_share * word_chars, n_lost,
               b"\n".join(kept_lines).decode())


#: Columns added by ``judge``.
ADDED = (("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
         ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
         ("kept", pa.bool_()), ("n_lost_lines", pa.int64()), ("clean_text", pa.string()))


def judge(docs: DataFrame, text_col: str = "text", rules: Rules = Rules(),
          prefix: str = "") -> DataFrame:
    """``docs`` with the columns of ``ADDED`` (names led by ``prefix``); input
    columns of these names are replaced."""
    names = [prefix + name for name, _ in ADDED]
    docs, back = undotted(without(docs, *names))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows: list[tuple] = []
        for _, _, buf, at in W.runs(batch.column(text_col)):
            rows += _judge(buf, at, rules)
        cols = [pa.array(v, t) for v, (_, t) in zip(zip(*rows), ADDED)]
        return pa.RecordBatch.from_arrays([*batch.columns, *cols], [*batch.schema.names, *names])

    kinds = {pa.int64(): LongType(), pa.bool_(): BooleanType(), pa.string(): StringType()}
    schema = StructType(list(docs.schema.fields))
    for name, (_, kind) in zip(names, ADDED):
        schema = schema.add(name, kinds[kind])
    return docs.mapInArrow(per_batch(one), schema).withColumnsRenamed(back)


def clean(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that are kept, with the failing lines removed from
    ``text`` and ``n_chars`` (if there) set to the new length."""
    prefix = "_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    judged = judge(docs, "text", rules, prefix).filter(F.col(f"{prefix}kept"))
    text = F.col(f"{prefix}clean_text")
    cols = [text.alias(c) if c == "text" else
            F.length(text).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else
            F.col(f"`{c}`") for c in docs.columns]
    return judged.select(*cols)
