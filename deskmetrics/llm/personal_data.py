"""Personal data by a semi-Markov conditional random field.

Base spans come from expressions: ``email``, ``ip`` (parts at most 255),
``card`` (16 to 19 digits that pass the Luhn check) and ``phone`` (a plus sign,
8 to 15 digits), leftmost and non-overlapping per kind; a match that fails its
check still takes up its characters.

The field adds spans that the expressions miss: numbers written without a plus
sign, cards that stand beside other numbers or are grouped by dots, addresses
with a spelt-out sign.  It looks at windows (stretches of number characters
with 7 digits or more, and surroundings of an at sign), cuts them into tokens,
and scores whole segments: the features of a candidate are those of the whole
span (digit groups, separators, checks, neighbours), never of single tokens.
Segments of a kind have at most ``MAX_TOKENS`` tokens, all others one, so the
dynamic program over (place, kind) is linear in the window; it chooses borders
and kinds together.  Outside the windows every segment is "no entity".

Training: the base spans are the labels.  Windows are grouped by their lattice
(tokens, candidates, features, labels) over the whole table, as rows in Spark;
the ``max_lattices`` most frequent ones, each with a weight of 1 + log(count),
and variants of them (``variants``: the same entities written otherwise, and
numbers that are none) are the sample on which the driver maximises the
conditional likelihood (forward-backward over segments, a ridge, Rprop).

Defined results: a NULL or empty text has no spans; repeated rows are scanned
alike; NULL ids pass through; an empty table gives an empty result; a table
without any window gives a model that adds nothing; input columns with the
names of added ones are replaced.  Spans are in code points, the end
exclusive, by kind, then start; added ones do not touch base ones.
"""

from __future__ import annotations

import json
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from hashlib import blake2b
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import per_batch, undotted, without

KINDS = ("email", "ip", "card", "phone")
# fixed values: what the base kinds match; a digit run is entered at its first digit only
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
CARD_DIGITS, PHONE_DIGITS = (16, 19), (8, 15)

MAX_TOKENS = 40
LEAST_DIGITS = 7
_NUMBERS = re.compile(r"[+(]?[0-9](?:[0-9().\x20+-]*[0-9])?")
_AT = re.compile(r"@|\x20?[\[(]at[\])]\x20?")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|.", re.S)
#: What a segment of each kind may look like at all.
SHAPES = (
    re.compile(r"[A-Za-z0-9._%+-]+(?:@|\x20?[\[(]at[\])]\x20?)[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*"),
    re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"),
    re.compile(r"[0-9](?:[\x20.-]?[0-9]){11,18}"),
    re.compile(r"[+(]?[0-9](?:[().\x20-]{0,2}[0-9]){6,14}"),
)
OTHER, LABELS = 0, len(KINDS) + 1

Span = tuple[int, int, int]      # start, end, kind


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Spans of the expressions, by kind, then start."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = done + len(text[done:at].rstrip(LOCAL))
        host = DOMAIN.match(text, at + 1) if start < at else None
        if host:
            out.append((start, host.end(), 0))
        done = host.end() if host else at + 1
        at = text.find("@", done)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), m.end(), 1))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0]:
            digits = _digits(m[0])
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                out.append((m.start(), m.end(), 2))
    for m in PHONE.finditer(text):
        if PHONE_DIGITS[0] <= len(_digits(m[0])) <= PHONE_DIGITS[1]:
            out.append((m.start(), m.end(), 3))
    return out


def windows(text: str) -> list[tuple[int, int]]:
    """The stretches that may hold an entity, disjoint, in order."""
    found = [(m.start(), m.end()) for m in _NUMBERS.finditer(text)
             if m.end() - m.start() >= LEAST_DIGITS and len(_digits(m[0])) >= LEAST_DIGITS]
    if "@" in text or "at]" in text or "at)" in text:
        done = 0
        for m in _AT.finditer(text):
            start = done + len(text[done:m.start()].rstrip(LOCAL))
            host = _HOST.match(text, m.end()) if start < m.start() else None
            done = m.end()
            if host:
                found.append((start, host.end()))
        found.sort()
    merged: list[tuple[int, int]] = []
    for start, end in found:
        if merged and start < merged[-1][1]:
            merged[-1] = merged[-1][0], max(end, merged[-1][1])
        else:
            merged.append((start, end))
    return merged


def _class(c: str) -> str:
    return "end" if not c else "space" if c.isspace() else "digit" if c.isdigit() else "letter" if c.isalpha() else c


def features(kind: int, span: str, left: str, right: str) -> list[str]:
    """Features of a whole candidate span of a kind (0: email) and of the
    characters beside it."""
    out = ["bias", f"left {_class(left)}", f"right {_class(right)}"]
    if kind == 0:
        sign = _AT.search(span)
        host = span[sign.end():]
        out += [f"sign {sign[0].strip()}", f"dots {min(host.count('.'), 2)}",
                f"top {host.rpartition('.')[2].isalpha() and '.' in host}", f"name {min(sign.start(), 3)}"]
    else:
        groups = [len(g) for g in re.findall("[0-9]+", span)]
        marks = "".join(sorted(set(re.sub("[0-9]", "", span))))
        out += [f"digits {sum(groups)}", f"marks {marks}", f"first {_class(span[0])}",
                "groups " + ("-".join(map(str, groups)) if len(groups) <= 5 else "many"),
                f"open {span.count('(') - span.count(')')}", f"one {len(groups) == 1} {_class(left)} {_class(right)}"]
        if kind == 1:
            out.append(f"parts {all(int(p) <= 255 for p in span.split('.'))}")
        if kind == 2:
            digits = _digits(span)
            out += [f"check {luhn(digits)}", f"check {luhn(digits)} {len(digits) >= CARD_DIGITS[0]}"]
    return [f"{KINDS[kind]} {f}" for f in out]


@dataclass
class Lattice:
    """Tokens of a window and its candidate segments, by end, then start."""
    borders: list[int]                                     # offset of each token, and the end
    segments: list[tuple[int, int, int, list[str]]]        # first token, last token + 1, label, features


def lattice(text: str, start: int, end: int, taken: Sequence[Span] = ()) -> Lattice:
    """Candidates touching a span of ``taken`` are left out."""
    tokens = [m.span() for m in _TOKEN.finditer(text, start, end)]
    borders = [a for a, _ in tokens] + [end]
    segments = []
    free = bytearray(b"\1" * (end - start))
    for a, b, _ in taken:
        a, b = max(a - start, 0), min(b - start, end - start)
        free[a:max(b, a)] = b"\0" * max(b - a, 0)
    digits = np.concatenate([[0], np.cumsum([b - a if text[a].isdigit() else 0 for a, b in tokens])]).tolist()
    signs = [m.start() for m in _AT.finditer(text, start, end)]
    for j in range(1, len(borders)):
        a, b = tokens[j - 1]
        shape = "digits" if text[a].isdigit() else "letters" if text[a].isalpha() else text[a]
        segments.append((j - 1, j, OTHER, [f"other {shape}" + (f" {min(b - a, 20)}" if shape == "digits" else "")]))
        for i in range(j - 1, max(j - 1 - MAX_TOKENS, -1), -1):
            lo, hi = borders[i], borders[j]
            if not free[lo - start] or not free[hi - 1 - start] or 0 in free[lo - start:hi - start]:
                break
            n = digits[j] - digits[i]
            has_sign = any(lo < s < hi for s in signs)
            if n > CARD_DIGITS[1] and not signs:
                break
            if n < 4 and not has_sign:
                continue
            left, right = text[lo - 1:lo], text[hi:hi + 1]
            span = text[lo:hi]
            for kind in ((0,) if has_sign else (1, 2, 3)):
                if (kind < 2 or n >= LEAST_DIGITS) and SHAPES[kind].fullmatch(span):
                    segments.append((i, j, kind + 1, features(kind, span, left, right)))
    return Lattice(borders, segments)


@dataclass
class Field:
    """Weights of segment features and of neighbouring labels."""
    weights: dict[str, float] = field(default_factory=dict)
    steps: np.ndarray = field(default_factory=lambda: np.zeros((LABELS, LABELS)))

    def score(self, names: list[str]) -> float:
        return sum(self.weights.get(f, 0.0) for f in names)

    def decode(self, cells: Lattice) -> list[tuple[int, int, int]]:
        """The best segmentation's entities as (first token, end token, label)."""
        n = len(cells.borders) - 1
        best = [[-np.inf] * LABELS for _ in range(n + 1)]
        back: list[list] = [[None] * LABELS for _ in range(n + 1)]
        best[0][OTHER] = 0.0
        steps = self.steps.tolist()
        for i, j, y, names in cells.segments:
            own = self.score(names)
            for x in range(LABELS):
                value = best[i][x] + steps[x][y] + own
                if value > best[j][y]:
                    best[j][y], back[j][y] = value, (i, x)
        out, j, y = [], n, int(np.argmax(best[n]))
        while j:
            i, x = back[j][y]
            if y != OTHER:
                out.append((i, j, y))
            j, y = i, x
        return out[::-1]


def _sum_exp(values: list[float]) -> float:
    top = max(values)
    return top + log(sum(exp(v - top) for v in values)) if top > -np.inf else top


def expected(cells: Lattice, scores: list[float], steps: list[list[float]]) -> tuple[float, list[float], np.ndarray]:
    """(log of the sum over all segmentations, chance of each segment, expected
    label steps), by the forward and backward recursions over segments."""
    n = len(cells.borders) - 1
    none = -np.inf
    labels = range(LABELS)
    into = defaultdict(list)
    for s, (i, j, y, _) in enumerate(cells.segments):
        into[j].append((s, i, y))
    ahead = [[none] * LABELS for _ in range(n + 1)]
    ahead[0][OTHER] = 0.0
    for j in range(1, n + 1):
        parts = [[] for _ in labels]
        for s, i, y in into[j]:
            parts[y].append(_sum_exp([ahead[i][x] + steps[x][y] for x in labels]) + scores[s])
        ahead[j] = [_sum_exp(p) if p else none for p in parts]
    behind = [[none] * LABELS for _ in range(n + 1)]
    behind[n] = [0.0] * LABELS
    rest = [[[] for _ in labels] for _ in range(n + 1)]
    for j in range(n, 0, -1):
        if j < n:
            behind[j] = [_sum_exp(p) if p else none for p in rest[j]]
        for s, i, y in into[j]:
            for x in labels:
                rest[i][x].append(steps[x][y] + scores[s] + behind[j][y])
    total = _sum_exp(ahead[n])
    chance, moves = [0.0] * len(cells.segments), np.zeros((LABELS, LABELS))
    for s, (i, j, y, _) in enumerate(cells.segments):
        for x in labels:
            v = ahead[i][x] + steps[x][y] + scores[s] + behind[j][y] - total
            if v > -700:
                p = exp(v)
                chance[s] += p
                moves[x, y] += p
    return total, chance, moves


@dataclass
class Example:
    cells: Lattice
    gold: list[int]          # segments of the labelled segmentation, in order
    weight: float


def labelled(text: str, start: int, end: int, spans: Sequence[Span]) -> tuple[Lattice, list[int]] | None:
    """The window's lattice and the segments that ``spans`` stand for (of
    overlapping spans the first counts); None where a span is no candidate."""
    cells = lattice(text, start, end)
    at = {(cells.borders[i], cells.borders[j], y): s for s, (i, j, y, _) in enumerate(cells.segments)}
    gold, place = [], start
    inside = sorted(s for s in spans if s[0] < end and s[1] > start)
    for a, b, kind in [*inside, (end, end, -1)]:
        if a < place:
            continue
        for i, lo in enumerate(cells.borders[:-1]):
            if place <= lo < a:
                gold.append(at[lo, cells.borders[i + 1], OTHER])
        if kind >= 0:
            if (a, b, kind + 1) not in at:
                return None
            gold.append(at[a, b, kind + 1])
            place = b
    return cells, gold


def fit(examples: Sequence[Example], ridge: float = 0.02, rounds: int = 60) -> Field:
    """Largest conditional likelihood of the labelled segmentations (Rprop)."""
    names = sorted({f for e in examples for *_, fs in e.cells.segments for f in fs})
    if not names:
        return Field()
    index = {f: k for k, f in enumerate(names)}
    ids = [[np.array([index[f] for f in fs]) for *_, fs in e.cells.segments] for e in examples]
    size = len(names) + LABELS * LABELS
    seen = np.zeros(size)
    for e, own in zip(examples, ids):
        before = OTHER
        for s in e.gold:
            y = e.cells.segments[s][2]
            seen[own[s]] += e.weight
            seen[len(names) + before * LABELS + y] += e.weight
            before = y
    w, step, last = np.zeros(size), np.full(size, 0.1), np.zeros(size)
    for _ in range(rounds):
        gradient = seen - ridge * w
        steps = w[len(names):].reshape(LABELS, LABELS).tolist()
        for e, own in zip(examples, ids):
            _, chance, moves = expected(e.cells, [float(w[k].sum()) for k in own], steps)
            np.subtract.at(gradient, np.concatenate(own), np.repeat(chance, [len(k) for k in own]) * e.weight)
            gradient[len(names):] -= moves.ravel() * e.weight
        turn = gradient * last
        step = np.clip(np.where(turn > 0, step * 1.2, np.where(turn < 0, step * 0.5, step)), 1e-6, 1.0)
        gradient[turn < 0] = 0
        w += np.sign(gradient) * step
        last = gradient
    return Field(dict(zip(names, w[:len(names)].tolist())), w[len(names):].reshape(LABELS, LABELS))


def variants(text: str, spans: Sequence[Span]) -> Iterator[tuple[str, list[Span]]]:
    """A window with one entity, written otherwise: (text, its spans)."""
    if len(spans) != 1:
        return
    (a, b, kind), = spans
    span, pre, post = text[a:b], text[:a], text[b:]

    def made(new: str, is_entity: bool = True) -> tuple[str, list[Span]]:
        return pre + new + post, [(a, a + len(new), kind)] if is_entity else []

    digits = _digits(span)
    if kind == 0:
        name, _, host = span.partition("@")
        for sign in (" [at] ", " (at) ", "[at]", "(at)"):
            yield made(name + sign + host)
        yield made(name + "@" + host.partition(".")[0], False)
    elif kind == 1:
        parts = span.split(".")
        yield made(".".join([*parts[:3], "300"]), False)
        yield made(".".join([*parts, parts[0]]), False)
    elif kind == 2:
        wrong = digits[:-1] + str((int(digits[-1]) + 5) % 10)
        for mark in ("", " ", "-", "."):
            yield made(mark.join(digits[k:k + 4] for k in range(0, len(digits), 4)))
            yield made(mark.join(wrong[k:k + 4] for k in range(0, len(digits), 4)), False)
        yield pre + digits + " " + wrong + post, [(a, a + len(digits), 2)]
        yield pre + wrong + " " + digits + post, [(a + len(wrong) + 1, a + len(wrong) + 1 + len(digits), 2)]
    elif len(digits) >= 10:
        area, office, line = digits[-10:-7], digits[-7:-4], digits[-4:]
        for new in (f"({area}) {office}-{line}", f"{area}-{office}-{line}", f"{area}.{office}.{line}",
                    f"1-{area}-{office}-{line}"):
            yield made(new)
        for new in (digits, f"20{area[1:]}-0{line[0]}-1{line[1]}", f"{line}{office}.{area}", f"{office}{line}",
                    f"{office} {line}", f"{area} {office} {line} {area}", f"{line} {line} {line}"):
            yield made(new, False)


def _examples(rows: Sequence[tuple[str, int]]) -> list[Example]:
    """Examples from (window as JSON, count), and their variants."""
    out, known = [], set()

    def add(text: str, start: int, end: int, spans: Sequence[Span], weight: float) -> None:
        pair = labelled(text, start, end, spans)
        key = pair and (tuple(map(str, pair[0].segments)), tuple(pair[1]))
        if pair and key not in known:
            known.add(key)
            out.append(Example(*pair, weight))

    sample = [(*json.loads(row), n) for row, n in rows]
    for left, window, right, spans, n in sample:
        add(left + window + right, len(left), len(left) + len(window), [tuple(s) for s in spans], 1 + log(n))
    for left, window, right, spans, n in sample:
        for text, marked in variants(left + window + right, [tuple(s) for s in spans]):
            for a, b in windows(text):
                add(text, a, b, marked, 1.0)
    return out


def training_windows(text: str, max_tokens: int) -> Iterator[tuple[bytes, str]]:
    """(lattice fingerprint, window as JSON) of each window of a text."""
    base = base_spans(text)
    for start, end in windows(text):
        if end - start > 8 * max_tokens:
            continue
        left, right = text[max(start - 1, 0):start], text[end:end + 1]
        inside = [(a - start + len(left), b - start + len(left), k) for a, b, k in base if a < end and b > start]
        row = left + text[start:end] + right
        pair = labelled(row, len(left), len(left) + end - start, inside)
        if pair and len(pair[0].borders) <= max_tokens + 1:
            key = blake2b(repr((pair[0].segments, pair[1])).encode(), digest_size=16).digest()
            yield key, json.dumps([left, text[start:end], right, inside])


def learn(docs: DataFrame, text_col: str = "text", max_lattices: int = 400, max_tokens: int = 64) -> Field:
    """The field of a table; at most ``max_lattices`` windows of at most
    ``max_tokens`` tokens each reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            sample: dict[bytes, str] = {}
            for text in batch.column(0):
                for key, row in training_windows(text.as_py() or "", max_tokens):
                    seen[key] += 1
                    sample[key] = min(row, sample.get(key, row))
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(seen), pa.binary()), pa.array([sample[k] for k in seen], pa.string()),
                     pa.array(list(seen.values()), pa.int64())], ["key", "row", "n"])

    texts = docs.select(F.col(f"`{text_col}`").alias("text")).filter(F.col("text").rlike("[0-9@]"))
    rows = (texts.mapInArrow(run, "key binary, row string, n bigint").groupBy("key")
            .agg(F.min("row").alias("row"), F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "key").limit(max_lattices).collect())
    return fit(_examples([(r["row"], r["n"]) for r in rows]))


def added_spans(text: str, model: Field, base: Sequence[Span]) -> list[Span]:
    """Spans that the field finds beside the base spans."""
    out = []
    for start, end in windows(text):
        taken = [s for s in base if s[0] < end and s[1] > start]
        cells = lattice(text, start, end, taken)
        if any(y != OTHER for _, _, y, _ in cells.segments):
            out += [(cells.borders[i], cells.borders[j], y - 1) for i, j, y in model.decode(cells)]
    return out


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


def scan(docs: DataFrame, model: Field, text_col: str = "text", out_col: str = "spans") -> DataFrame:
    """``docs`` with an array of (kind, start, end, base) in ``out_col``, by
    kind, then start."""
    docs, back = undotted(without(docs, out_col))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for cell in batch.column(text_col):
            text = cell.as_py() or ""
            base = base_spans(text)
            found = [(k, a, b, True) for a, b, k in base] + \
                [(k, a, b, False) for a, b, k in added_spans(text, model, base)]
            rows.append([{"kind": KINDS[k], "start": a, "end": b, "base": is_base}
                         for k, a, b, is_base in sorted(found)])
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, SPANS)], [*batch.schema.names, out_col])

    kind = StructType.fromDDL("s array<struct<kind:string,start:int,end:int,base:boolean>>")["s"].dataType
    schema = StructType(list(docs.schema.fields)).add(out_col, kind)
    return docs.mapInArrow(per_batch(one), schema).withColumnsRenamed(back)


def listed(found: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
