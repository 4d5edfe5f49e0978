"""Quality classifier: a generalised additive model with pairwise interactions.

Shape measures of a text are cut into bins. Boosting goes round the measures in
turn; each step fits a shallow tree on one measure's bins to the present residual
and adds it to that measure's lookup table. The strongest pairs then get tables
of their own in the same way. A score is the logistic of one table entry per
measure and pair, so scoring is a gather and a sum over whole blocks of rows.

Edge cases: NULL text counts as empty; every text, empty or very long, gets a
score. Labels that are NULL teach nothing, and of a document with several labels
the smallest counts. Without labelled rows of both kinds every score is the
smoothed share of ones. Repeated rows are scored each; of a labelled document with
several texts, the one with the least hash is learned from. The order of rows and their
partitions change nothing. Columns beyond ``doc_id``
and ``text`` are not looked at.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, map_batches

SAMPLE = 20_000  # labelled documents that the model is fitted on at most; of more, those with a low hash of doc_id

_CLASS = np.zeros((256, 6))  # letter, digit, upper, blank, sentence mark, symbol
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = (_b >= 128 or _c.isalpha(), 48 <= _b < 58, 65 <= _b < 91, _c in " \t\n\r", _c in ".,;:?!'\"", 33 <= _b < 128 and not _c.isalnum() and _c not in ".,;:?!'\"")

MEASURES = ["log_bytes", "letters", "digits", "uppers", "blanks", "marks", "symbols", "log_words", "word_length", "distinct", "top_word", "runs", "entropy", "odd_ends", "distinct_pairs", "lines", "repeated_lines", "line_length", "bars", "shouts", "packed", "long_words"]


def measure(text: str | None) -> list[float]:
    """The measures of one whole text, in the order of MEASURES."""
    data = (text or "").encode("utf-8", "replace")
    size = max(len(data), 1)
    kinds = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _CLASS / size
    words = data.lower().split()
    n = max(len(words), 1)
    counts = Counter(words)
    shares = np.fromiter(counts.values(), float, len(counts)) / n
    lengths = np.fromiter(map(len, words), float, len(words))
    runs = sum(a == b for a, b in zip(words, words[1:]))
    odd = sum(w[-1:] in b"%&*#$!|~^=" for w in words)
    pairs = len(set(zip(words, words[1:])))
    lines = data.split(b"\n")
    return [
        np.log1p(len(data)), *kinds, np.log1p(len(words)), lengths.mean() if words else 0.0, len(counts) / n, max(shares, default=0.0), runs / n,
        float(-(shares * np.log(shares)).sum()) / max(np.log(n), 1.0), odd / n, pairs / n, len(lines) / n, 1 - len(set(lines)) / len(lines),
        np.log1p(len(data) / len(lines)), data.count(b"|") / n, data.count(b"!") / n, len(zlib.compress(data, 1)) / size, float((lengths > 20).mean()) if words else 0.0,
    ]


def _leaves(g: np.ndarray, h: np.ndarray, depth: int, ridge: float) -> np.ndarray:
    """A tree's value for each bin, from the bins' gradient and weight sums."""
    total = g.sum() / (h.sum() + ridge)
    if depth == 0 or len(g) < 2:
        return np.full(len(g), total)
    left_g, left_h = g.cumsum()[:-1], h.cumsum()[:-1]
    gain = left_g**2 / (left_h + ridge) + (g.sum() - left_g) ** 2 / (h.sum() - left_h + ridge)
    at = int(gain.argmax()) + 1
    return np.concatenate([_leaves(g[:at], h[:at], depth - 1, ridge), _leaves(g[at:], h[at:], depth - 1, ridge)])


def _quarters(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Gain and values of the best cut of a two-way table into four parts."""
    G, H = (np.pad(x, ((1, 0), (1, 0))).cumsum(0).cumsum(1) for x in (g, h))

    def parts(x):
        a, b, c = x[1:-1, 1:-1], x[1:-1, -1:], x[-1:, 1:-1]
        return np.stack([a, b - a, c - a, x[-1, -1] - b - c + a])

    pg, ph = parts(G), parts(H)
    gain = (pg**2 / (ph + ridge)).sum(0)
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    value = (pg[:, i, j] / (ph[:, i, j] + ridge)).reshape(2, 2)
    rows, cols = (np.arange(g.shape[0]) > i).astype(int), (np.arange(g.shape[1]) > j).astype(int)
    return float(gain[i, j] - g.sum() ** 2 / (h.sum() + ridge)), value[np.ix_(rows, cols)]


class Additive:
    """cuts: bin edges per measure; tables: one value per bin; pairs: (i, j, coarse table)."""

    def __init__(self, bins: int = 32, coarse: int = 8, rounds: int = 150, pair_rounds: int = 60, pairs: int = 8, rate: float = 0.1, depth: int = 2, ridge: float = 5.0):
        self.bins, self.coarse, self.rounds, self.pair_rounds = bins, coarse, rounds, pair_rounds
        self.most_pairs, self.rate, self.depth, self.ridge = pairs, rate, depth, ridge
        self.base, self.cuts, self.wide, self.tables, self.pairs = 0.0, [], [], [], []

    @staticmethod
    def _binned(cuts: list[np.ndarray], x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, k], side="right") for k, c in enumerate(cuts)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Additive:
        share = (y.sum() + 1) / (len(y) + 2)
        self.base = float(np.log(share / (1 - share)))
        if not len(y) or y.min() == y.max():
            return self
        quantile = lambda n: [np.unique(np.quantile(x[:, k], np.arange(1, n) / n)) for k in range(x.shape[1])]
        self.cuts, self.wide = quantile(self.bins), quantile(self.coarse)
        fine, broad = self._binned(self.cuts, x), self._binned(self.wide, x)
        self.tables = [np.zeros(len(c) + 1) for c in self.cuts]
        score = np.full(len(y), self.base)

        def residual() -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-score))
            return y - p, p * (1 - p)

        for _ in range(self.rounds):
            for k, table in enumerate(self.tables):
                g, h = (np.bincount(fine[:, k], v, len(table)) for v in residual())
                step = self.rate * _leaves(g, h, self.depth, self.ridge)
                table += step
                score += step[fine[:, k]]

        def table_of(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
            shape = len(self.wide[i]) + 1, len(self.wide[j]) + 1
            cell = broad[:, i] * shape[1] + broad[:, j]
            return tuple(np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in residual())

        split = [k for k, c in enumerate(self.wide) if len(c)]
        gains = sorted(((_quarters(*table_of(i, j), self.ridge)[0], i, j) for a, i in enumerate(split) for j in split[a + 1 :]), reverse=True)
        self.pairs = [(i, j, np.zeros((len(self.wide[i]) + 1, len(self.wide[j]) + 1))) for _, i, j in gains[: self.most_pairs]]
        for _ in range(self.pair_rounds):
            for i, j, table in self.pairs:
                step = self.rate * _quarters(*table_of(i, j), self.ridge)[1]
                table += step
                score += step[broad[:, i], broad[:, j]]
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        if self.tables:
            fine, broad = self._binned(self.cuts, x), self._binned(self.wide, x)
            for k, table in enumerate(self.tables):
                score += table[fine[:, k]]
            for i, j, table in self.pairs:
                score += table[broad[:, i], broad[:, j]]
        return 1 / (1 + np.exp(-score))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = SAMPLE) -> Additive:
    """The model of a bounded sample: all labelled documents, or of more than ``most`` those whose hash is under a threshold.

    The threshold lets nine tenths of ``most`` through, so that more than ``most`` is out of question. Only their
    measures, rows of a few numbers, come to the driver.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.min(label).alias("target"))
    n = known.count()
    share = 1.0 if n <= most else 0.9 * most / n
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int(share * (1 << 40)))

    def measured(source: Iterator[tuple]) -> Iterator[list]:
        for held in blocks(source, 1):
            yield [[r[0] for r in held], [measure(r[1]) for r in held], [float(r[2]) for r in held], [r[3] for r in held]]

    joined = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "text", "target", F.xxhash64("text").alias("print"))
    rows = map_batches(joined, measured, "doc_id long, x array<double>, y double, print long")
    found = rows.groupBy("doc_id").agg(F.min(F.struct("print", "x", "y")).alias("r")).select("doc_id", "r.x", "r.y").collect()
    found.sort(key=lambda r: r.doc_id)
    return Additive().fit(np.array([r.x for r in found]).reshape(-1, len(MEASURES)), np.array([r.y for r in found]))


def score(docs: DataFrame, model: Additive) -> DataFrame:
    """``doc_id, score, predicted`` for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # plain arrays, as workers may lack the class

    def scored(source: Iterator[tuple]) -> Iterator[list]:
        own = Additive()
        vars(own).update(shared.value)
        for held in blocks(source, 1):
            values = own.predict(np.array([measure(r[1]) for r in held]))
            yield [[r[0] for r in held], values, (values >= 0.5).astype(np.int32)]

    return map_batches(docs.select("doc_id", "text"), scored, "doc_id long, score double, predicted int")
