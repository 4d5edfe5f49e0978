"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The score of a document and an item is that of the best local alignment (a match counts
1, a mismatch or gap -0.5) over the item's number of words. A document is a copy from
``least`` on, if the alignment is worth ``FEWEST`` matches, or the whole of a shorter item.

Seeds are word pairs of an item at a distance of one or two, and find the same pairs of a
document at either distance. An alignment of the score s with m matches has at most
2 * (m - s) errors, so of the m - 1 steps from a match to the next, at least s - 1 hold one
error or none: each of these is a seed, and they begin at different places of the item.
So of an item's places that begin seeds, all but s - 2 must contain one that a copy has,
and the rarest ones are chosen, by how many documents of the corpus have their seeds. Common
word pairs therefore bring no document and item together, and no copy is lost, however
often it occurs. The same bound, on all of an item's seeds, settles most of the rest: a
document with fewer than s - 1 of them is no copy.

Then, within an alignment, a document's word that the item does not have costs 0.5, so no
alignment scores more than the largest sum over a run of words with 1 for each word of
the item and -0.5 for others. The start of a best alignment has a positive score too, so an
alignment lies in one stretch on which these sums stay positive. Only stretches that reach the
wanted score are aligned, and none that could is left out.

The benchmark is sent to the workers in chunks of about ``chunk`` words (hashed; a longer
item is one), each with its own pass, so a large benchmark needs more passes and no more memory.
Documents are never shuffled.

Edge cases: words are runs of ASCII letters and digits, A-Z lower-cased, and of all
other characters beyond ASCII. An item without words, and a NULL or empty document, matches
nothing. Equal items are reported each. Repeated rows are reported each. Columns beyond
``doc_id``, ``text`` and ``item_id`` are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, by_size, map_batches, rows, tidy

LEAST = 0.4  # score from which a place counts as a copy
FEWEST = 3  # matches that it must be worth, unless the item is shorter
CHUNK = 1_000_000  # words of the benchmark on a worker at a time
ENTRIES = 1 << 20  # of seeds in items that are listed at a time
_WORD_BYTES = bytes(b + 32 if 65 <= b < 91 else b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else 32 for b in range(256))


def split(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_WORD_BYTES).split() if text else []


class Items:
    """Benchmark items by word number, and the seeds that begin at each of their places."""

    def __init__(self, items: list[tuple[int, str]], least: float):
        self.vocabulary: dict[bytes, int] = {}
        self.ids, self.words = [], []
        for item, text in items:
            words = split(text)
            if words:
                self.ids.append(item)
                self.words.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.int64))
        self.need = np.array([max(least * len(w), min(len(w), FEWEST)) for w in self.words])
        self.steps = np.array([max(1, math.ceil(n - 1 - 1e-9)) for n in self.need], np.int64)  # seeds that a copy has
        near, far = [], []
        for words in self.words:
            codes = words << 32
            if len(words) > 1:
                near.append(codes[:-1] | words[1:])
                far.append(np.append(codes[:-2] | words[2:], 0))
            else:  # a single word is its own seed
                near.append(codes)
                far.append(np.zeros(1, np.int64))
        self.places = np.array([len(x) for x in near], np.int64)  # of each item
        self.starts = np.cumsum(self.places) - self.places
        both = np.concatenate([*near, *far]) if near else np.zeros(0, np.int64)
        self.distinct = np.unique(both[both > 0])
        at = np.searchsorted(self.distinct, both)
        at[both == 0] = len(self.distinct)  # no seed
        self.near, self.far = np.split(at, 2)
        self.single = np.unique([int(w[0]) for w in self.words if len(w) == 1]).astype(np.int64)
        size = 1 << max(16, (16 * len(self.distinct)).bit_length())
        self.shift = np.uint64(64 - size.bit_length() + 1)
        self.sieve = np.zeros(size, bool)
        self.sieve[self._sieved(self.distinct)] = True

    def _sieved(self, codes: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def numbered(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """A block's words by number, 0 for words in no item, with two 0 after each text; and where each text begins."""
        flat: list[bytes] = []
        starts = [0]
        for text in texts:
            flat += split(text)
            flat += (b" ", b" ")
            starts.append(len(flat))
        return np.fromiter(map(self.vocabulary.get, flat, repeat(0)), np.int64, len(flat)), np.array(starts)

    def cells(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The seeds that each text has, as numbers ``text * (number of seeds + 1) + seed``, sorted."""
        out = []
        for distance in (1, 2):
            codes = words[:-distance] << 32 | words[distance:]
            codes[(words[:-distance] == 0) | (words[distance:] == 0)] = 0
            out.append(self._known(codes, starts))
        if len(self.single):
            out.append(self._known(np.where(np.isin(words, self.single), words << 32, 0), starts))
        return np.unique(np.concatenate(out))

    def _known(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(codes)
        at = at[self.sieve[self._sieved(codes[at])]]
        spot = np.minimum(np.searchsorted(self.distinct, codes[at]), len(self.distinct) - 1)
        good = self.distinct[spot] == codes[at]
        return (np.searchsorted(starts, at[good], side="right") - 1) * (len(self.distinct) + 1) + spot[good]

    def rare(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By seed: where its items begin and end in the last list, of the items in which it is one of the rare seeds."""
        counts = np.append(counts, 0)
        often = counts[self.near] + counts[self.far]
        item = np.repeat(np.arange(len(self.words)), self.places)
        order = np.lexsort((often, item))
        rank = np.arange(len(item)) - self.starts[item]  # in that order
        chosen = order[rank <= (self.places - self.steps)[item]]
        seeds = np.concatenate([self.near[chosen], self.far[chosen]])
        pairs = np.unique(seeds * max(len(self.words), 1) + np.tile(item[chosen], 2))
        seeds, items = np.divmod(pairs, max(len(self.words), 1))
        edges = np.searchsorted(seeds, np.arange(len(self.distinct) + 1))
        return edges[:-1], edges[1:], items


def align(item: np.ndarray, words: np.ndarray) -> tuple[float, int, int]:
    """Score, start and end (in ``words``) of the best local alignment; unknown words match nothing."""
    n = len(words)
    best, where = 0.0, (0, 0)
    column = np.arange(n + 1) / 2
    row, began = np.zeros(n + 1), np.arange(n + 1)
    for word in item:
        step = np.where(words == word, 1.0, -0.5)
        from_before, down = row[:-1] + step, row[1:] - 0.5
        value = np.zeros(n + 1)
        start = np.arange(n + 1)
        diagonal = from_before >= down
        value[1:] = np.where(diagonal, from_before, down)
        start[1:] = np.where(diagonal, began[:-1], began[1:])
        start = np.where(value > 0, start, np.arange(n + 1))
        value = np.maximum(value, 0)
        # gaps along the row: the best earlier cell less half a point a step
        lifted = value + column
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted >= top, np.arange(n + 1), 0))
        row, began = top - column, start[source]
        at = int(row.argmax())
        if row[at] > best:
            best, where = float(row[at]), (int(began[at]), at)
    return best, *where


def _pairs(items: Items, rare: tuple[np.ndarray, np.ndarray, np.ndarray], cells: np.ndarray) -> Iterator[tuple[int, int]]:
    """(text, item) for each two that share a rare seed and enough seeds of all."""
    begin, end, of_seed = rare
    base, n_items = len(items.distinct) + 1, max(len(items.words), 1)
    doc, seed = np.divmod(cells, base)
    times = end[seed] - begin[seed]
    for part in _portions(times):
        n = times[part]
        entry = np.repeat(begin[seed[part]] - np.cumsum(n) + n, n) + np.arange(n.sum())
        yield from _enough(items, np.repeat(doc[part], n) * n_items + of_seed[entry], cells, base, n_items)


def _portions(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Places of consecutive entries whose sizes sum to about ENTRIES; empty entries are left out."""
    full = np.flatnonzero(sizes)
    sums = np.cumsum(sizes[full])
    first = 0
    while first < len(full):
        before = sums[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(sums, before + ENTRIES, side="right")))
        yield full[first:last]
        first = last


def _enough(items: Items, pairs: np.ndarray, cells: np.ndarray, base: int, n_items: int) -> Iterator[tuple[int, int]]:
    """Of the pairs ``text * n_items + item``, those where the text has as many seeds of the item as a copy must."""
    doc, item = np.divmod(np.unique(pairs), n_items)
    for part in _portions(items.places[item]):
        d, i = doc[part], item[part]
        n = items.places[i]
        pair = np.repeat(np.arange(len(part)), n)
        place = np.repeat(items.starts[i] - np.cumsum(n) + n, n) + np.arange(n.sum())
        there = np.zeros(len(place), bool)
        for seeds in (items.near, items.far):
            wanted = d[pair] * base + seeds[place]
            there |= cells[np.minimum(np.searchsorted(cells, wanted), len(cells) - 1)] == wanted
        good = np.bincount(pair, there, len(part)) >= items.steps[i]
        yield from zip(d[good].tolist(), i[good].tolist(), strict=True)


def _stretches(own: np.ndarray, need: float) -> list[tuple[int, int]]:
    """Where an alignment may score ``need``, from which of a document's words are the item's."""
    sums = np.concatenate([[0.0], np.cumsum(np.where(own, 1.0, -0.5))])
    height = sums - np.minimum.accumulate(sums)
    cuts = np.flatnonzero(height == 0)
    good = np.flatnonzero(np.maximum.reduceat(height, cuts) >= need)
    ends = np.append(cuts[1:], len(own))
    return list(zip(cuts[good].tolist(), ends[good].tolist(), strict=True))


def _best(items: Items, rare: tuple, texts: list[str | None]) -> dict[tuple[int, int], tuple[float, int, int]]:
    """(text, item) of every copy: its score, less where it begins, and its number of words."""
    words, starts = items.numbered(texts)
    cells = items.cells(words, starts)
    mark = np.zeros(len(items.vocabulary) + 1, bool)
    best: dict[tuple[int, int], tuple] = {}
    for doc, item in dict.fromkeys(_pairs(items, rare, cells)):
        wanted, need = items.words[item], items.need[item] - 1e-9
        whole = words[starts[doc] : starts[doc + 1] - 2]
        mine, times = np.unique(wanted, return_counts=True)
        mark[mine] = True
        own = mark[whole]
        mark[mine] = False
        if np.count_nonzero(own) < need:
            continue
        for low, high in _stretches(own, need):
            span = whole[low:high]
            there, n = np.unique(span[span > 0], return_counts=True)
            spot = np.minimum(np.searchsorted(there, mine), len(there) - 1)
            if np.minimum(np.where(there[spot] == mine, n[spot], 0), times).sum() < need:  # fewer matches than the score needs
                continue
            score, start, end = align(wanted, span)
            if score >= need:
                row = (score / len(wanted), -(low + start), end - start)
                best[doc, item] = max(best.get((doc, item), row), row)
    return best


def _chunks(items: DataFrame, chunk: int) -> list[DataFrame]:
    """The items in parts of about ``chunk`` words."""
    words = items.agg(F.coalesce(F.sum(F.size(F.split("text", " "))), F.lit(0))).head()[0]
    count = max(1, -(-2 * words // chunk))
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k) for k in range(count)] if count > 1 else [items]


def _models(docs: DataFrame, benchmark: DataFrame, least: float, chunk: int) -> Iterator[Broadcast]:
    """For every chunk of the benchmark: its texts, and in how many documents each of its seeds is."""
    for part in _chunks(benchmark.select("item_id", "text").where("text IS NOT NULL"), chunk):
        texts = sorted((tuple(r) for r in part.collect()), key=lambda r: (r[0] is not None, r))
        items = Items(texts, least)
        if items.words:
            counts = np.zeros(len(items.distinct), np.int64)
            shared = docs.sparkSession.sparkContext.broadcast(texts)
            found = _frequencies(docs, shared, least).toArrow()  # a row for each seed of the chunk at most
            counts[found.column("seed").to_numpy()] = found.column("n").to_numpy()
            yield docs.sparkSession.sparkContext.broadcast((texts, counts))


def _frequencies(docs: DataFrame, shared: Broadcast, least: float) -> DataFrame:
    """(seed, n): the number of documents with each seed, added up in the tasks first."""

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(shared.value, least)
        sums = np.zeros(len(items.distinct) + 1, np.int64)
        for held in blocks(rows(batches), 0):
            sums += np.bincount(items.cells(*items.numbered([r[0] for r in held])) % len(sums), minlength=len(sums))
        seed = np.flatnonzero(sums)
        yield pa.record_batch({"seed": seed, "n": sums[seed]})

    return docs.select("text").mapInArrow(count, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n"))


def find(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, item_id, score, first_word, words``: every document with a place like an item, the best place of each pair."""
    schema = "doc_id long, item_id long, score double, first_word long, words long"
    docs = docs.select("doc_id", "text")
    out = docs.sparkSession.createDataFrame([], schema)
    for shared in _models(docs, benchmark, least, chunk):

        def run(source: Iterator[tuple], shared: Broadcast = shared) -> Iterator[list]:
            texts, counts = shared.value
            items = Items(texts, least)
            rare = items.rare(counts)
            for held in blocks(source, 1):
                best = _best(items, rare, [r[1] for r in held])
                if best:
                    yield [[held[d][0] for d, _ in best], [items.ids[i] for _, i in best], [r[0] for r in best.values()], [-r[1] for r in best.values()], [r[2] for r in best.values()]]

        out = out.unionByName(map_batches(docs, run, schema))
    return out


def without_copies(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, chunk: int = CHUNK) -> DataFrame:
    """The rows of ``docs``, with all their columns, that have no place like an item of the benchmark; nothing is shuffled."""
    out = docs
    for shared in _models(docs, benchmark, least, chunk):

        @tidy
        def run(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared) -> Iterator[pa.RecordBatch]:
            texts, counts = shared.value
            items = Items(texts, least)
            rare = items.rare(counts)
            for block in by_size(batches, "text", 4_000_000):
                copies = {doc for doc, _ in _best(items, rare, block.column("text").to_pylist())}
                yield block.filter(pa.array([i not in copies for i in range(block.num_rows)], pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out
