"""Hidden Markov language model.

Training is Baum-Welch: every partition runs the scaled forward-backward
recursion over its sequences and emits expected counts; the counts are added
up across partitions (as whole numbers of 1/4096, so the order of addition
does not matter and a task that runs again adds the same) and the driver
re-estimates the tables, whose size is fixed by the parameters.  A long text is learned from in parts of
``segment`` tokens, read with ``context`` tokens of its neighbours on both
sides, so the recursions know the state at a cut; every token and every move
is counted in one part, and only the begin of a text is a start.  Scoring is
the exact likelihood of a whole text by the scaled forward recursion.

Symbols.  The ``top_words`` most frequent training words and the end token
emit themselves.  Any other word emits its suffix class (one of ``classes``),
and the word within the class has an add-one probability over the class's
training words and one slot for unseen ones.  The word part needs the count
of each rare token: a join of rare tokens with the word counts, on the word.
All counts are over all training texts; the vocabulary is not capped.

Defined results: a NULL or empty text is the end token alone; repeated rows
are scored alike; a NULL id counts as the text '' in the split; with no
training text the counts are zero and the model is the uniform start model;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import drop_staged, held_out, staged

END = 1                     # "hash" of the end token
UNIT = 4096                 # counts are added in units of 1 / UNIT
BATCH_TOKENS = 1_000_000    # tokens that one recursion handles side by side


@dataclass(frozen=True)
class Settings:
    states: int = 8
    iterations: int = 4
    top_words: int = 32_000     # with classes + 1 below 65,536
    classes: int = 512
    segment: int = 2048         # training counts a text in parts of so many tokens
    context: int = 64           # tokens (at least 1) that a part reads on both sides
    prior: float = 5000.0       # tokens' worth of the unigram model in each state
    seed: int = 7


@dataclass
class Model:
    settings: Settings
    top: np.ndarray                   # ascending word hashes (int64)
    top_symbol: np.ndarray            # their symbols, 1..
    top_count: np.ndarray             # training counts by symbol (0 is the end)
    n: int = 0                        # training tokens
    v: int = 0                        # distinct training tokens
    class_norm: np.ndarray = field(default_factory=lambda: np.zeros(0))  # log10(N_c + V_c + 1)
    unigram: np.ndarray = field(default_factory=lambda: np.zeros(0))
    start: np.ndarray = field(default_factory=lambda: np.zeros(0))
    move: np.ndarray = field(default_factory=lambda: np.zeros(0))
    emit: np.ndarray = field(default_factory=lambda: np.zeros(0))        # symbols x states


# --- words ------------------------------------------------------------------

def _suffix_class(w: W.Words, classes: int) -> np.ndarray:
    """A class from the last three bytes of each word, lower-cased."""
    code = W._CODES[True]
    total = np.zeros(len(w.starts), np.uint64)
    for back in (1, 2, 3):
        at = w.ends - back
        byte = np.where(at >= w.starts, code[w.buf[np.maximum(at, 0)]], np.uint64(0))
        total = total * np.uint64(1_000_003) + byte
    return (W.mix(total) % np.uint64(classes)).astype(np.int32)


def _count_words(classes: int):
    """mapInArrow: (h, class, c) of a partition, merged before they are sent."""
    def merged(parts):
        h = np.concatenate([p[0] for p in parts])
        cls = np.concatenate([p[1] for p in parts])
        c = np.concatenate([p[2] for p in parts])
        u, at, inv = np.unique(h, return_index=True, return_inverse=True)
        return u, cls[at], np.bincount(inv, c, len(u)).astype(np.int64)

    def out(part) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(part[0]), pa.array(part[1]), pa.array(part[2])], ["h", "cls", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            if batch.num_rows:
                parts.append((np.array([END], np.int64), np.zeros(1, np.int32),
                              np.array([batch.num_rows], np.int64)))
            for _, _, w in W.run_words(batch.column(0)):
                h = w.hashes().view(np.int64)
                u, at, c = np.unique(h, return_index=True, return_counts=True)
                parts.append((u, _suffix_class(w, classes)[at], c))
                held += len(u)
            if held > 2_000_000:
                part = merged(parts)
                parts, held = [part], len(part[0])
                if held > 1_000_000:
                    yield out(part)
                    parts, held = [], 0
        if parts:
            yield out(merged(parts))
    return run


def _with_vocabulary(vocab: DataFrame, s: Settings) -> Model:
    """The model's fixed-size tables from the counts of all training words."""
    n, v, ends = vocab.agg(F.sum("c"), F.count("*"), F.sum(F.when(F.col("h") == END, F.col("c")))).first()
    words = vocab.filter(F.col("h") != END)
    # counts by eighths of a power of two (at most 512 rows) tell which words can be among the top
    level = F.floor(F.log2("c") * 8)
    least, so_far = 0, 0
    for row in sorted(words.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect(), reverse=True):
        least, so_far = row.level, so_far + row.n
        if so_far >= s.top_words:
            break
    top = words.filter(level >= least).orderBy(F.desc("c"), "h").limit(s.top_words).select("h", "c").toArrow()
    h, c = (top.column(i).combine_chunks().to_numpy(zero_copy_only=False) for i in (0, 1))
    order = np.argsort(h)
    model = Model(s, h[order], np.arange(1, len(h) + 1)[order],
                  np.concatenate([[ends or 0], c]).astype(np.int64), n or 0, v or 0)
    rare = words
    if len(h):
        rare = words.filter((F.col("c") < int(c[-1])) | ((F.col("c") == int(c[-1])) & (F.col("h") > int(h[-1]))))
    total, kinds = np.zeros(s.classes), np.zeros(s.classes)
    for row in rare.groupBy("cls").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        total[row.cls], kinds[row.cls] = row.n, row.v
    model.class_norm = np.log10(total + kinds + 1)
    weight = np.concatenate([model.top_count, total]) + 1.0
    model.unigram = weight / weight.sum()
    return model


def _encode(model: Model):
    """mapInArrow (id, text, held_out) -> symbols, base sums, rare words."""
    first_class = len(model.top_count)
    logs = np.log10(model.top_count + 1.0)
    known = model.top_count > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, w in W.run_words(batch.column(1)):
                h = w.hashes().view(np.int64)
                at = np.minimum(np.searchsorted(model.top, h), max(len(model.top) - 1, 0))
                is_top = model.top[at] == h if len(model.top) else np.zeros(len(h), bool)
                symbol = first_class + _suffix_class(w, model.settings.classes)
                symbol[is_top] = model.top_symbol[at[is_top]]
                base = np.concatenate([[0.0], np.cumsum(np.where(is_top, logs[np.where(is_top, symbol, 0)], 0.0))])
                tops = np.concatenate([[0], np.cumsum(is_top)])
                f = w.first
                rare_first = f - tops[f]
                ids = np.insert(symbol, f[1:], 0).astype("<u2")   # the end after each text
                ends = f[1:] + np.arange(1, hi - lo + 1)
                begins = f[:-1] + np.arange(hi - lo)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo),
                    pa.array(ends - begins, pa.int64()),
                    pa.array([ids[a:b].tobytes() for a, b in zip(begins, ends)], pa.binary()),
                    pa.array(tops[f[1:]] - tops[f[:-1]] + int(known[0]), pa.int64()),
                    pa.array(base[f[1:]] - base[f[:-1]] + logs[0], pa.float64()),
                    pa.ListArray.from_arrays(pa.array(rare_first.astype(np.int32)), pa.array(h[~is_top])),
                ], ["id", "held_out", "n_tokens", "ids", "n_top", "top_log", "rare"])
    return run


# --- recursions ---------------------------------------------------------------

class _Side:
    """Sequences laid out longest first; step t handles those longer than t."""

    def __init__(self, lengths: np.ndarray):
        begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        self.order = np.argsort(-lengths, kind="stable")
        self.begins = begins[self.order]
        falling = lengths[self.order]
        self.steps = int(falling[0])
        self.active = np.searchsorted(-falling, -np.arange(self.steps), "left")

    def at(self, t: int) -> np.ndarray:
        return self.begins[:self.active[t]] + t


def forward_log10(model: Model, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """log10 likelihood of each symbol sequence (lengths are at least 1)."""
    side, out = _Side(lengths), np.zeros(len(lengths))
    state = None
    for t in range(side.steps):
        at = side.at(t)
        prior = model.start if t == 0 else state[:len(at)] @ model.move
        state = prior * model.emit[ids[at]]
        total = state.sum(1)
        state /= total[:, None]
        out[:len(at)] += np.log10(total)
    result = np.empty_like(out)
    result[side.order] = out
    return result


def expected_counts(model: Model, ids: np.ndarray, lengths: np.ndarray, own: np.ndarray | None = None):
    """Expected emissions (symbols x states), moves and starts of the sequences.
    ``own`` has the begin and end of what each sequence counts (default: all);
    one that begins later than 0 is no text's begin, so no start."""
    k, side = len(model.start), _Side(lengths)
    emit, move = model.emit.astype(np.float32), model.move.astype(np.float32)
    if own is None:
        own = np.stack([np.zeros(len(lengths), int), lengths], 1)
    begin, end = own[side.order].T
    settled = np.full(k, 1 / k) @ np.linalg.matrix_power(model.move, 1024)
    first = np.where((begin == 0)[:, None], model.start, settled).astype(np.float32)
    alpha = np.empty((len(ids), k), np.float32)
    scale = np.empty(len(ids), np.float32)
    state = None
    for t in range(side.steps):
        at = side.at(t)
        prior = first if t == 0 else state[:len(at)] @ move
        state = prior * emit[ids[at]]
        total = state.sum(1)
        state /= total[:, None]
        alpha[at], scale[at] = state, total
    moves = np.zeros((k, k))
    beta = np.ones((0, k), np.float32)
    for t in range(side.steps - 1, -1, -1):
        at = side.at(t)
        now = np.ones((len(at), k), np.float32)
        if len(beta):
            m, after = len(beta), side.at(t + 1)
            ahead = emit[ids[after]] * beta / scale[after][:, None]
            counted = (begin[:m] <= t + 1) & (t + 1 < end[:m])      # moves into the part's own tokens
            moves += (alpha[at[:m]] * counted[:, None]).T @ ahead
            now[:m] = ahead @ move.T
        beta = now
        alpha[at] *= beta                       # alpha becomes the state posterior
    place = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    mine = (place >= np.repeat(own[:, 0], lengths)) & (place < np.repeat(own[:, 1], lengths))
    emits = np.stack([np.bincount(ids[mine], alpha[mine, j], len(emit)) for j in range(k)], 1)
    return emits, moves * model.move, alpha[side.at(0)[begin == 0]].sum(0, dtype=np.float64)


def _parts(batches: Iterator[pa.RecordBatch], segment: int, context: int):
    """(symbols, lengths, own) of parts of texts, about BATCH_TOKENS tokens at a time."""
    ids, lengths, own, held = [], [], [], 0

    def together():
        return np.concatenate(ids).astype(np.int32), np.array(lengths), np.array(own)

    for batch in batches:
        for raw in batch.column("ids"):
            s = np.frombuffer(raw.as_buffer(), "<u2")
            for a in range(0, len(s), segment):
                lo, hi = max(0, a - context), min(len(s), a + segment + context)
                ids.append(s[lo:hi])
                lengths.append(hi - lo)
                own.append((a - lo, min(a + segment, len(s)) - lo))
                held += hi - lo
                if held >= BATCH_TOKENS:
                    yield together()
                    ids, lengths, own, held = [], [], [], 0
    if ids:
        yield together()


def _batches(batches: Iterator[pa.RecordBatch]):
    """(rows, symbols, lengths) of whole texts, about BATCH_TOKENS tokens at a time."""
    rows, ids, lengths, held = [], [], [], 0
    for batch in batches:
        for i, raw in enumerate(batch.column("ids")):
            s = np.frombuffer(raw.as_buffer(), "<u2")
            rows.append((batch, i))
            ids.append(s)
            lengths.append(len(s))
            held += len(s)
            if held >= BATCH_TOKENS:
                yield rows, np.concatenate(ids).astype(np.int32), np.array(lengths)
                rows, ids, lengths, held = [], [], [], 0
    if rows:
        yield rows, np.concatenate(ids).astype(np.int32), np.array(lengths)


def _expect(model: Model):
    """mapInArrow: rows (what, x, k0..): emissions 0, moves 1, starts 2."""
    k = len(model.start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emits, moves, starts = 0.0, 0.0, 0.0
        for ids, lengths, own in _parts(batches, model.settings.segment, model.settings.context):
            e, m, s = expected_counts(model, ids, lengths, own)
            emits, moves, starts = emits + e, moves + m, starts + s
        if isinstance(emits, float):
            return
        used = np.flatnonzero(emits.any(1))
        what = np.concatenate([np.zeros(len(used)), np.ones(k), [2]]).astype(np.int32)
        x = np.concatenate([used, np.arange(k), [0]]).astype(np.int32)
        table = np.rint(np.concatenate([emits[used], moves, starts[None]]) * UNIT).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(what), pa.array(x), *[pa.array(np.ascontiguousarray(table[:, j])) for j in range(k)]],
            ["what", "x", *[f"k{j}" for j in range(k)]])
    return run


def _initial(model: Model) -> None:
    """States that differ by seeded noise and tend to stay."""
    s = model.settings
    rng = np.random.default_rng(s.seed)
    noise = np.exp(rng.normal(0, 0.5, (len(model.unigram), s.states)))
    emit = model.unigram[:, None] * noise
    model.emit = emit / emit.sum(0)
    model.start = np.full(s.states, 1 / s.states)
    stay = 0.95
    model.move = np.full((s.states, s.states), (1 - stay) / max(s.states - 1, 1))
    np.fill_diagonal(model.move, stay if s.states > 1 else 1.0)


def _reestimate(model: Model, counts) -> None:
    s = model.settings
    emits = np.zeros((len(model.unigram), s.states))
    moves, starts = np.zeros((s.states, s.states)), np.zeros(s.states)
    what, x = (counts.column(i).to_numpy() for i in (0, 1))
    table = np.stack([counts.column(2 + j).to_numpy() for j in range(s.states)], 1) / UNIT
    emits[x[what == 0]] = table[what == 0]
    moves[x[what == 1]] = table[what == 1]
    if (what == 2).any():
        starts = table[what == 2][0]
    emit = emits + s.prior * model.unigram[:, None]
    model.emit = emit / emit.sum(0)
    moves += 1.0
    model.move = moves / moves.sum(1, keepdims=True)
    model.start = (starts + 1.0) / (starts + 1.0).sum()


# --- the operator -------------------------------------------------------------

def train_and_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    is_held_out: Column | None = None,
                    settings: Settings = Settings()) -> DataFrame:
    """(``id_col``, held_out, n_tokens, n_known, train_tokens, base_score,
    score) for every row of ``docs``; the model learns from rows that are not
    held out (default: crc32 of the id as text modulo 7 is 2)."""
    s = settings
    is_held_out = held_out(id_col, 7) == 2 if is_held_out is None else is_held_out
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                      is_held_out.alias("held_out"))
    vocab = staged(
        src.filter(~F.col("held_out")).select("text")
        .mapInArrow(_count_words(s.classes), "h long, cls int, c long")
        .groupBy("h").agg(F.min("cls").alias("cls"), F.sum("c").alias("c")), "vocabulary")
    model = _with_vocabulary(vocab, s)
    kind = docs.schema[id_col].dataType.simpleString()
    encoded = staged(
        src.mapInArrow(_encode(model), f"id {kind}, held_out boolean, n_tokens long, ids binary, "
                       "n_top long, top_log double, rare array<long>")
        .withColumn("row", F.monotonically_increasing_id()), "symbols")
    _initial(model)
    learn = encoded.filter(~F.col("held_out")).select("ids")
    sums = ", ".join(f"k{j} long" for j in range(s.states))
    for _ in range(s.iterations):
        counts = (learn.mapInArrow(_expect(model), f"what int, x int, {sums}").groupBy("what", "x")
                  .agg(*[F.sum(f"k{j}").alias(f"k{j}") for j in range(s.states)]))
        _reestimate(model, counts.toArrow())
    rare = (encoded.select("row", F.explode("rare").alias("h")).join(vocab.select("h", "c"), "h")
            .groupBy("row").agg(F.count("*").alias("n_rare"), F.sum(F.log10(F.col("c") + 1)).alias("rare_log")))
    scored = (_score(encoded, model, kind).join(rare, "row", "left")
              .na.fill({"n_rare": 0, "rare_log": 0.0}))
    out = staged(scored.select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("n_top") + F.col("n_rare")).alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"),
        (F.col("top_log") + F.col("rare_log")
         - F.col("n_tokens") * float(np.log10(model.n + model.v + 1))).alias("base_score"),
        (F.col("chain_log") + F.col("rare_log")).alias("score")), "scores")
    drop_staged(vocab, encoded)
    return out


def _score(encoded: DataFrame, model: Model, kind: str) -> DataFrame:
    first_class = len(model.top_count)
    # a word in its class costs -log10(N_c + V_c + 1); the joined part adds log10(c + 1)
    cost = np.concatenate([np.zeros(first_class), model.class_norm])
    keep = ["row", "id", "held_out", "n_tokens", "n_top", "top_log"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ids, lengths in _batches(batches):
            chain = forward_log10(model, ids, lengths)
            paid = np.concatenate([[0.0], np.cumsum(cost[ids])])
            ends = np.cumsum(lengths)
            log = chain - (paid[ends] - paid[ends - lengths])
            done = 0
            while done < len(rows):
                batch, lo = rows[done]
                hi = lo
                while done + hi - lo < len(rows) and rows[done + hi - lo][0] is batch:
                    hi += 1
                part = batch.slice(lo, hi - lo).select(keep)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(log[done:done + hi - lo])], [*keep, "chain_log"])
                done += hi - lo
    return encoded.select(*keep, "ids").mapInArrow(
        run, f"row long, id {kind}, held_out boolean, n_tokens long, n_top long, "
             "top_log double, chain_log double")
