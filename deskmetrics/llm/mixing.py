"""Mixing sources to target weights, by soft membership.

Domains are the label combinations of a labelled table.  A classifier trained
on labelled documents gives every document a posterior over the domains, so a
document belongs to all of them in part.  Each document gets a rate (how often
it is taken on average) from 0 to ``MAX_RATE``.  The rates are the optimum of

    |shares - targets|^2 + PULL * sum of m_i (rate_i - 1)^2

shares being the expected tokens by domain over all tokens, and m_i the share
of a document (half by its tokens, half as one document), so a target is not
met by copying short documents only.  The pull to one is fixed: documents that
no target asks away keep a rate near one, and what distance from the targets
remains is reported (``Fit.residual``), not chased by throwing rows away.

The optimum is found by accelerated projected gradient.  A step needs of all
documents only the k share gaps, one pass that adds up one row per task; the
rates themselves are replayed from those numbers, so nothing per document is
written between passes and a lost executor costs nothing but its tasks.

The lexical part of the classifier counts hashed words and stems
(``features.BUCKETS``) of labelled documents, on two quarters of them while the
third quarter fits a softmax regression on the lexical sums and the style
features; the fourth calibrates the posteriors (one temperature).  At most
``MAX_LABELS`` labelled rows are used.

Defined results: a NULL or empty text has no tokens, a posterior like any
other and so a rate; repeated rows get equal rates; a NULL id is hashed as
NULL; a domain without labelled documents is left out and the targets are
scaled to sum to one; without labels all documents are in one domain; an
empty table gives an empty result; further columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructType

from . import features
from . import words as W
from .common import drop_staged, every, fresh, staged, undotted, without

#: Production targets: shares of all tokens by domain.
TARGETS = {"good": 0.9, "low": 0.1, "toxic": 0.0}
MAX_LABELS = 20_000
#: Weight of staying at a rate of one, against the squared shares.
PULL = 1e-3
#: The greatest rate.
MAX_RATE = 4.0
#: Passes at most; more is an error.
PASSES = 400


def domain_of(quality: Column, toxic: Column) -> Column:
    """The domain of a label row: toxic, low (quality 0) or good."""
    return F.when(toxic == 1, "toxic").when(quality == 0, "low").when(quality == 1, "good")


@dataclass(frozen=True)
class Classifier:
    domains: tuple[str, ...]
    odds: np.ndarray            # buckets x domains: log odds of a word
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray         # features x domains

    def posteriors(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(words, posteriors) of each text."""
        x, n = describe(texts, self.odds)
        return n, _softmax(_scaled(x, self.mean, self.scale) @ self.weights)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _scaled(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.concatenate([np.clip((x - mean) / scale, -8, 8), np.ones((len(x), 1))], 1)


def describe(texts: pa.Array, odds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Style features and, by domain, mean and greatest log odds of the words
    and of their stems, and how many are nearly as telling as any can be."""
    lexical, counts = [], []
    k = odds.shape[1]
    telling = 0.7 * odds.max(0)
    for lo, hi, first, *kinds in features.word_buckets(texts):
        n = np.diff(first)
        some = n > 0
        part = np.zeros((hi - lo, 6 * k))
        for at, buckets in zip((0, 3 * k), kinds):
            if len(buckets):
                value = odds[buckets]
                total = np.concatenate([np.zeros((1, k)), np.cumsum(value, 0)])
                part[:, at:at + k] = (total[first[1:]] - total[first[:-1]]) / np.maximum(n, 1)[:, None] * 10
                part[some, at + k:at + 2 * k] = np.maximum.reduceat(value, first[:-1][some], 0)
                part[some, at + 2 * k:at + 3 * k] = np.log1p(
                    np.add.reduceat(value > telling, first[:-1][some], 0, dtype=float))
        lexical.append(part)
        counts.append(n)
    if not lexical:
        return np.zeros((0, len(features.NAMES) + 6 * k)), np.zeros(0, np.int64)
    return np.concatenate([features.style(texts), np.concatenate(lexical)], 1), np.concatenate(counts)


def _count_buckets(n_domains: int):
    """mapInArrow (y, text): documents with each bucket, by domain."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((2 * features.BUCKETS, n_domains), np.int64)
        for batch in batches:
            y = batch.column(0).to_numpy()
            for lo, hi, first, *kinds in features.word_buckets(batch.column(1)):
                for buckets in kinds:
                    for r in range(hi - lo):
                        table[np.unique(buckets[first[r]:first[r + 1]]), y[lo + r]] += 1
        used = np.flatnonzero(table.any(1))
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)), *[pa.array(np.ascontiguousarray(table[used, j]))
                                                    for j in range(n_domains)]],
                ["bucket", *[f"n{j}" for j in range(n_domains)]])
    return run


def _described(odds: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, _ = describe(batch.column(1), odds)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(list(x), pa.list_(pa.float64()))], ["y", "x"])
    return run


def _fit_softmax(x: np.ndarray, y: np.ndarray, k: int, ridge: float = 1e-3) -> np.ndarray:
    """Softmax regression by accelerated full gradient steps."""
    w = np.zeros((x.shape[1], k))
    ahead, pace = w.copy(), 1.0
    hot = np.eye(k)[y]
    rate = 1.0 / (0.5 * np.linalg.norm(x.T @ x / len(x), 2) + ridge)
    for _ in range(400):
        step = ahead - rate * (x.T @ (_softmax(x @ ahead) - hot) / len(x) + ridge * ahead)
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = step + (pace - 1) / faster * (step - w)
        w, pace = step, faster
    return w


def _temperature(z: np.ndarray, y: np.ndarray) -> float:
    """What to divide scores by, so that the posteriors of labelled rows that
    the weights were not fitted on are likeliest (1 without such rows)."""
    if not len(y):
        return 1.0
    loss = lambda t: -np.log(_softmax(z / t)[np.arange(len(y)), y] + 1e-300).mean()
    return float(min(np.exp(np.linspace(np.log(0.25), np.log(8), 101)), key=loss))


def learn(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          domain_col: str = "domain", max_labels: int = MAX_LABELS) -> Classifier | None:
    """A classifier from (``id_col``, ``domain_col``) rows, of which at most
    ``max_labels`` are used (the least by a hash of the id)."""
    known = labelled.select(F.col(id_col).alias("id"), F.col(domain_col).alias("domain")) \
        .filter("id is not null and domain is not null")
    sample = known.orderBy(F.xxhash64("id"), "id").limit(max_labels)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # the sample has at most max_labels short rows
    rows = staged(src.join(F.broadcast(sample), "id").select("id", "domain", "text"), "labelled")
    counts = {r.domain: r.n for r in rows.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    domains = tuple(sorted(counts))
    if len(domains) < 2:
        return None
    number = F.array_position(F.array(*[F.lit(d) for d in domains]), F.col("domain")).cast("int") - 1
    # two quarters count words, one fits the weights, one the temperature; the
    # classifier then uses the counts of all four
    parts = rows.select(number.alias("y"), "text", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)).cast("int").alias("part"))
    k = len(domains)
    cols = [f"n{j}" for j in range(2 * k)]
    later = (F.col("part") >= 2).cast("int")
    table = (parts.select((F.col("y") + k * later).alias("y"), "text")
             .mapInArrow(_count_buckets(2 * k), "bucket int, " + ", ".join(f"{c} long" for c in cols))
             .groupBy("bucket").agg(*[F.sum(c).alias(c) for c in cols]).toArrow())
    seen = np.zeros((2 * features.BUCKETS, 2 * k))
    seen[table.column(0).to_numpy()] = np.stack([table.column(1 + j).to_numpy() for j in range(2 * k)], 1)
    share = np.array([counts[d] for d in domains]) / sum(counts.values())
    # log odds of the domain given the word, shrunk to 0 for rare words
    odds_of = lambda n: np.log((n + 4 * share) / (n.sum(1, keepdims=True) + 4) / share)
    odds = odds_of(seen[:, :k])
    fitted = parts.filter("part >= 2").select((F.col("y") + k * (F.col("part") - 2)).alias("y"), "text").mapInArrow(
        _described(odds), "y int, x array<double>").toArrow()
    drop_staged(rows)
    if not fitted.num_rows:
        return None
    x, y = np.stack(fitted.column("x").to_numpy()), fitted.column("y").to_numpy()
    mean, scale = x.mean(0), x.std(0) + 1e-6
    x, last = _scaled(x, mean, scale), y >= k
    if last.all():
        last[:] = False
    weights = _fit_softmax(x[~last], y[~last] % k, k)
    return Classifier(domains, odds_of(seen[:, :k] + seen[:, k:]), mean, scale,
                      weights / _temperature(x[last] @ weights, y[last] % k))


def with_posteriors(docs: DataFrame, classifier: Classifier | None, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with ``n_tokens`` (words) and ``posterior``;
    input columns of these names are replaced."""
    docs, back = undotted(without(docs, "n_tokens", "posterior"))
    kept = [c for c in docs.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column(text_col)
            if classifier is None:
                n = np.concatenate([w.counts for _, _, w in W.run_words(texts)])
                p = np.ones((len(n), 1))
            else:
                n, p = classifier.posteriors(texts)
            yield pa.RecordBatch.from_arrays(
                [*batch.select(kept).columns, pa.array(n.astype(np.int64)), pa.array(list(p), pa.list_(pa.float64()))],
                [*kept, "n_tokens", "posterior"])

    schema = StructType([docs.schema[c] for c in kept])
    schema = schema.add("n_tokens", LongType()).add("posterior", ArrayType(DoubleType()))
    return docs.mapInArrow(run, schema).withColumnsRenamed(back)


@dataclass(frozen=True)
class Fit:
    """Rates as the gradient steps that lead to them: what a step needs from
    all documents is the k share gaps, so a document's rate is found again
    from its tokens, its posterior and those numbers."""
    goal: np.ndarray            # shares of the tokens by domain
    typical: float              # mean tokens of a document
    step: float
    gaps: tuple[np.ndarray, ...] = ()       # shares minus goal at each look-ahead point
    momenta: tuple[float, ...] = ()         # of the steps that are done
    shares: np.ndarray | None = None        # reached by the rates
    pull: float = PULL
    most: float = MAX_RATE

    @property
    def residual(self) -> float:
        """The greatest distance of a domain's share from its target."""
        return 0.0 if self.shares is None else float(np.abs(self.shares - self.goal).max())

    def replay(self, n: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(look-ahead point, rates before, rates after) of the last step."""
        weight = n / np.maximum(n + self.typical, 1e-300)
        ahead = before = rate = np.ones(len(n))
        for t, gap in enumerate(self.gaps):
            if t:
                ahead = rate + self.momenta[t - 1] * (rate - before)
            before, rate = rate, np.clip(
                ahead - self.step * (weight * (p @ gap) / self.pull + ahead - 1), 0.0, self.most)
        return ahead, before, rate


def _arrays(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and posteriors of a batch of (n_tokens, posterior)."""
    n = batch.column(0).to_numpy().astype(float)
    return n, batch.column(1).flatten().to_numpy().reshape(len(n), k)


def _totals(members: DataFrame, width: int, measure) -> np.ndarray:
    """The sum over all rows of the ``width`` numbers that ``measure`` gives a
    batch; one row per task, added up by Spark."""
    names = [f"s{j}" for j in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(width), False
        for batch in batches:
            if batch.num_rows:
                total, some = total + measure(batch), True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in total], names)
    rows = members.select("n_tokens", "posterior").mapInArrow(run, ", ".join(f"{c} double" for c in names))
    return np.array([v or 0.0 for v in rows.agg(*[F.sum(c) for c in names]).first()])


def solve(members: DataFrame, targets: np.ndarray, pull: float = PULL, most: float = MAX_RATE,
          tolerance: float = 5e-3, passes: int = PASSES) -> Fit:
    """The rates for ``targets`` (tokens by domain); ``members`` has
    ``n_tokens`` and ``posterior``.  A pass is one step: accelerated projected
    gradient, restarted where the look-ahead overshoots, until the projected
    gradient's root mean square (by m_i) is below the tolerance.  The objective
    curves by one at least, so the rates are as near to the optimum, by the
    same mean.  More than ``passes`` is an error."""
    k = len(targets)
    total = float(targets.sum())
    if total <= 0:
        return Fit(np.zeros(k), 1.0, 0.0)
    goal = targets / total

    def start(batch: pa.RecordBatch) -> np.ndarray:
        n, p = _arrays(batch, k)
        return np.concatenate([n @ p, [len(n)]])
    first = _totals(members, k + 1, start)
    typical = total / first[-1]

    def curve(batch: pa.RecordBatch) -> np.ndarray:
        n, p = _arrays(batch, k)
        return ((p * (n * n / (n + typical))[:, None]).T @ p).ravel()
    steepest = np.linalg.eigvalsh(_totals(members, k * k, curve).reshape(k, k) / total).max()
    # sums of doubles depend on their order in the last digits
    gap = np.round(first[:k] / total - goal, 9)
    fit = Fit(goal, typical, 1.0 / (1.0 + max(steepest, 0.0) / pull), (gap,), (), None, pull, most)
    root = fit.step ** -0.5
    momentum = (root - 1) / (root + 1)
    for _ in range(passes):
        def look(batch: pa.RecordBatch, fit: Fit = fit) -> np.ndarray:
            n, p = _arrays(batch, k)
            ahead, before, rate = fit.replay(n, p)
            m = (n + typical) / 2
            return np.concatenate([(n * rate) @ p, (n * (rate + momentum * (rate - before))) @ p,
                                   [m @ ((ahead - rate) * (rate - before)), m @ (ahead - rate) ** 2]])
        *got, overshoot, slope = _totals(members, 2 * k + 2, look) / total
        if slope ** 0.5 <= tolerance * fit.step:
            return replace(fit, shares=np.array(got[:k]))
        go_on, at = (0.0, got[:k]) if overshoot > 0 else (momentum, got[k:])
        fit = replace(fit, gaps=(*fit.gaps, np.round(at - goal, 9)), momenta=(*fit.momenta, go_on))
    raise RuntimeError(f"rates still move after {passes} passes; shares {got[:k]}")


def with_rates(members: DataFrame, fit: Fit) -> DataFrame:
    """``members`` with ``rate`` (an input column of that name is replaced)."""
    members, back = undotted(without(members, "rate"))
    k = len(fit.goal)
    at = [members.columns.index(c) for c in ("n_tokens", "posterior")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rate = fit.replay(*_arrays(pa.RecordBatch.from_arrays([batch.column(i) for i in at], ["n", "p"]), k))[2]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rate)], [*batch.schema.names, "rate"])
    schema = StructType(list(members.schema.fields)).add("rate", DoubleType())
    return members.mapInArrow(run, schema).withColumnsRenamed(back)


def document_rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with ``n_tokens``, ``posterior``, ``rate``
    and one ``p_<domain>`` for each domain (input columns of these names are
    replaced).  The targets are shares of the
    tokens there are, so the mean rate of a token is one."""
    targets = TARGETS if targets is None else targets
    classifier = learn(docs, labelled, id_col, text_col)
    domains = classifier.domains if classifier else ("all",)
    members = staged(with_posteriors(docs, classifier, text_col), "members")
    tokens = members.agg(F.sum("n_tokens")).first()[0] or 0
    share = np.array([targets.get(d, 0.0) for d in domains]) if classifier else np.ones(1)
    if share.sum() <= 0:
        raise ValueError(f"no target for any of the domains {domains}")
    fit = solve(members, share / share.sum() * tokens)
    added = [f"p_{d}" for d in domains]
    rated = with_rates(without(members, *added), fit)
    return rated.select(*every(rated), *[F.get("posterior", F.lit(j)).alias(name) for j, name in enumerate(added)])


def copies(rate: Column, key: Column) -> Column:
    """How often a document is taken: the rate, rounded up or down by a hash of
    its key so that the mean over documents is the rate."""
    chance = F.pmod(F.xxhash64(key), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + (chance < rate - F.floor(rate)).cast("int")).cast("int")


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """``docs`` with each row taken as often as its rate says (not at all,
    once or repeatedly); rows of one id are taken alike."""
    rates = document_rates(docs.select("doc_id", "text"), labelled, targets)
    key, times, copy = (fresh(n, docs) for n in ("_key", "_times", "_copy"))
    taken = (rates.filter("doc_id is not null").groupBy("doc_id").agg(F.max("rate").alias("rate"))
             .select(F.col("doc_id").alias(key), copies(F.col("rate"), F.col("doc_id")).alias(times))
             .filter(F.col(times) > 0))
    repeated = docs.join(taken, docs["doc_id"] == F.col(key)).select(
        *every(docs), F.explode(F.sequence(F.lit(1), F.col(times))).alias(copy))
    return repeated.drop(copy).unionAll(docs.filter("doc_id is null"))
