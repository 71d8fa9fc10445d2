"""Periodic runs of words by Lyndon roots.

A run is a stretch of consecutive words with smallest period q that no
neighbouring word extends keeping period q.  Every run holds a Lyndon root (a
Lyndon word of length q) that is the longest Lyndon word at its place under
one of the two opposite orders of the alphabet.  The longest Lyndon words of
all places (the Lyndon array) come straight out of phase one of a
group-refining suffix sorter: groups of suffixes are taken from the greatest
down, and each passes its context on to the nearest suffixes before it that
are in lower groups; the context length of a suffix's last group is its entry.
Each root is extended to both sides by longest common extensions.

A run of exponent e holds each of its words floor(e) times at least, so a text
is first cut at words that are too rare for any wanted run, again within the
parts until nothing changes; what is left goes through the method whole.

Words are maximal runs of anything but ASCII white space.  Defined results: a
NULL or empty text has no words and no runs; repeated rows are treated alike;
NULL ids pass through; an empty table gives an empty result; input columns
with the names of added ones are replaced.  A text is the unit of work: its
words are held in one task, as its row is.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import SPACE_WORD, fresh, per_batch, undotted, without

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
ADDED = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def lyndon_array(codes: Sequence[int]) -> list[int]:
    """Length of the longest Lyndon word at each place of ``codes``, a
    sequence over 0..k-1 in which every value occurs; the end counts as
    smaller than any value."""
    k = max(codes, default=-1) + 1
    if not k:
        return []
    members: list[list[int]] = [[] for _ in range(k)]
    group = list(codes)
    for place, code in enumerate(codes):
        members[code].append(place)
    below = list(range(-1, k - 1))       # the groups as a linked list, least first; -1: none
    above = [*range(1, k), -1]
    size = [len(m) for m in members]
    context = [1] * k
    out = [0] * len(codes)
    up = list(range(len(codes) + 1))     # up[i + 1]: a place at or before i, shifted, that may be unfinished
    at = k - 1
    while at >= 0:
        here = [i for i in members[at] if group[i] == at]
        length = context[at]
        for i in here:
            out[i] = length
            up[i + 1] = i
        owed: dict[int, int] = {}        # shifted place -> members of this group that follow it
        for i in here:
            j = i
            while up[j] != j:
                up[j] = up[up[j]]
                j = up[j]
            if j:
                owed[j] = owed.get(j, 0) + 1
        for times in sorted(set(owed.values()), reverse=True):
            moved: dict[int, list[int]] = {}
            for j, n in owed.items():
                if n == times:
                    moved.setdefault(group[j - 1], []).append(j - 1)
            for old, places in moved.items():
                if len(places) == size[old]:
                    members[old] = places
                    context[old] += times * length
                    continue
                new, right = len(members), above[old]
                members.append(places)
                size.append(len(places))
                size[old] -= len(places)
                context.append(context[old] + times * length)
                below.append(old)
                above.append(right)
                above[old] = new
                if right >= 0:
                    below[right] = new
                for p in places:
                    group[p] = new
        at = below[at]
    return out


def _shared(codes: Sequence[int], i: int, j: int) -> int:
    """How far the sequence agrees from ``i`` and from ``j`` > i on."""
    start, step, n = i, 8, len(codes)
    while j < n:
        m = min(step, n - j)
        if codes[i:i + m] == codes[j:j + m]:
            i, j, step = i + m, j + m, step * 2
        elif m == 1:
            break
        else:
            step = m // 2
    return i - start


def _shared_back(codes: Sequence[int], i: int, j: int) -> int:
    """How far the sequence agrees ending just before ``i`` and before ``j`` > i."""
    end, step = i, 8
    while i > 0:
        m = min(step, i)
        if codes[i - m:i] == codes[j - m:j]:
            i, j, step = i - m, j - m, step * 2
        elif m == 1:
            break
        else:
            step = m // 2
    return end - i


def runs_of(codes: list[int], exponent: int = 2, least: int = 0) -> set[tuple[int, int, int]]:
    """(start, length, period) of all runs of that exponent and length or more
    (``exponent`` is 2 at least)."""
    k = max(codes, default=-1) + 1
    found = set()
    for order in (codes, [k - 1 - c for c in codes]):
        last: dict[int, tuple[int, int]] = {}      # period -> the stretch extended last
        for i, q in enumerate(lyndon_array(order)):
            begin, end = last.get(q, (0, 0))
            if begin <= i and i + q <= end:
                continue
            # with three periods or more, the first root is followed by another
            if exponent >= 3 and (i + 2 * q > len(codes) or codes[i] != codes[i + q]
                                  or codes[i:i + q] != codes[i + q:i + 2 * q]):
                continue
            begin = i - _shared_back(codes, i, i + q)
            end = i + q + _shared(codes, i, i + q)
            last[q] = begin, end
            if end - begin >= max(least, exponent * q):
                found.add((begin, end - begin, q))
    return found


def _parts(words: Sequence, times: int, least: int) -> Iterator[tuple[int, Sequence]]:
    """(offset, words) of the parts without a word that is rarer than ``times``
    in its part; no run of that exponent reaches beyond one."""
    todo = [(0, words)]
    while todo:
        offset, part = todo.pop()
        rare = {w for w, n in Counter(part).items() if n < times}
        if not rare:
            yield offset, part
        elif len(rare) * times < len(part) * times:      # some word may stay
            begin = 0
            cuts = [i for i, w in enumerate(part) if w in rare]
            for cut in (*cuts, len(part)):
                if cut - begin >= least:
                    todo.append((offset + begin, part[begin:cut]))
                begin = cut + 1


def word_runs(words: Sequence, exponent: int = 4, least: int = 6) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a word list, by start, then period."""
    found = []
    for offset, part in _parts(words, exponent, max(least, exponent)):
        code = {w: i for i, w in enumerate(dict.fromkeys(part))}
        found += [(offset + a, n, q) for a, n, q in runs_of([code[w] for w in part], exponent, least)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words: Sequence, found: Sequence[tuple[int, int, int]]) -> list:
    """The words that no run holds beyond its first period."""
    drop = bytearray(len(words))
    for start, length, period in found:
        drop[start + period:start + length] = b"\1" * (length - period)
    return [w for w, gone in zip(words, drop) if not gone] if found else list(words)


def find(docs: DataFrame, text_col: str = "text", exponent: int = 4, least: int = 6) -> DataFrame:
    """``docs`` with n_words, runs (start, length, period; by start, then
    period) and the text ``collapsed`` to the first period of each run."""
    if exponent < 2:
        raise ValueError("a run has two periods at least")
    docs, back = undotted(without(docs, "n_words", "runs", "collapsed"))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, found, texts = [], [], []
        for text in batch.column(text_col).cast(pa.large_binary()):
            words = (text.as_py() or b"").split()
            runs = word_runs(words, exponent, least)
            counts.append(len(words))
            found.append([{"start": a, "length": n, "period": q} for a, n, q in runs])
            texts.append(b" ".join(collapse(words, runs)))
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(counts, pa.int64()), pa.array(found, pa.list_(RUN)),
             pa.array(texts, pa.large_binary()).cast(pa.large_string()).cast(pa.string())],
            [*batch.schema.names, "n_words", "runs", "collapsed"])

    schema = StructType([*docs.schema.fields, *StructType.fromDDL(ADDED).fields])
    return docs.mapInArrow(per_batch(one), schema).withColumnsRenamed(back)


def with_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The texts whose id's crc32 is divisible by 10 with a periodic tail
    instead of their own (a third of its words to an eleventh as period); a
    NULL id counts as ''."""
    words, start, period = (fresh(c, docs) for c in ("words", "start", "period"))
    h = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    n, g, a, p = F.size(words), F.floor(h / 10), F.col(start), F.col(period)
    own = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(f"({SPACE_WORD})"))
    parts = docs.withColumn(words, F.when(h % 10 == 0, own)) \
        .withColumn(start, (g % F.nullif(n, F.lit(0))).cast("int")) \
        .withColumn(period, (1 + F.floor((n - a) / (3 + g % 8))).cast("int"))
    tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    made = F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a), tail), F.lit(1), n), " ")
    return parts.withColumn(text_col, F.when(a.isNull(), F.col(text_col)).otherwise(made)).drop(words, start, period)


def best(found: Column) -> Column:
    """(length, start, period) of the longest run, ties by start, then period;
    start and period are negated."""
    return F.array_max(F.transform(found, lambda r: F.struct(
        r["length"], (-r["start"]).alias("start"), (-r["period"]).alias("period"))))


def listed(found: Column) -> Column:
    """Every run as a line ``start,length,period``."""
    return F.concat(F.lit(""), F.array_join(F.transform(found, lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"),
        F.lit("\n"))), ""))
