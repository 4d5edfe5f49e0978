"""Language identification by rank-order profiles.

A language's profile is the list of its most frequent letter n-grams. A document
is ranked the same way, and each language gets the sum of the distances between
an n-gram's two ranks; an n-gram that a profile lacks costs the profile's length.
The language with the least sum wins, the first by name among equals.

Edge cases: a text that is NULL, empty or without a letter is ``und`` with score
0; so is any text when no row could be learned from. Rows without language or
text teach nothing. Repeated rows count as often as they occur. Equal counts are
ranked by the n-gram's code points, so results do not depend on partitioning.
More than ``MOST_LANGUAGES`` languages raise, as their profiles are sent to every worker.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, by_size, columns, map_batches, tidy, worker_memory

UNKNOWN = "und"
LONGEST = 3  # letters of the longest n-gram; three code points fit into one number
PROFILE = 400  # n-grams of a profile
MOST_LANGUAGES = 2000  # profiles are sent to every worker; more languages than this are refused
BLANK = 32


def _letters() -> np.ndarray:
    return worker_memory("letters", lambda: np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))


def grams(text: str | None) -> np.ndarray:
    """The n-grams of a text's words in lower case, each word with a blank at both ends; the lone blank is left out.

    An n-gram is the number that its code points make, 21 bits each.
    """
    if not text:
        return np.zeros(0, np.int64)
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letter = _letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of several blanks after a word
    keep[0] = True
    codes, letter = np.where(letter, codes, BLANK)[keep], letter[keep]
    if letter.any() and not letter[1]:  # the text's first blank and those before its first word are one
        codes, letter = codes[1:], letter[1:]
    two = codes[:-1] << 21 | codes[1:]
    return np.concatenate([codes[letter], two[letter[:-1] | letter[1:]], (two[:-1] << 21 | codes[2:])[letter[1:-1]]])


def gram_text(gram: int) -> str:
    return "".join(chr(c) for c in (gram >> 42, gram >> 21 & 0x1FFFFF, gram & 0x1FFFFF) if c)


def profiles(docs: DataFrame, length: int = PROFILE) -> DataFrame:
    """(lang, gram, place): the ``length`` most frequent n-grams of every language, over all rows of ``docs``.

    Counts are added up in the map tasks first, so a language with a third of the rows moves no more than its n-grams.
    """

    def count(source: Iterator[tuple]) -> Iterator[list]:
        for held in blocks(source, 1):
            parts = defaultdict(list)
            for lang, text in held:
                parts[lang].append(np.unique(grams(text), return_counts=True))
            for lang, found in parts.items():
                each, at = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
                yield [[lang] * len(each), each, np.bincount(at, np.concatenate([n for _, n in found]), len(each)).astype(np.int64)]

    learned = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    counts = map_batches(learned, count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= length)  # each task keeps its first ones only
    return ranked.select("lang", "gram", (F.col("rank") - 1).alias("place"))


def load(table: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, the profiles' n-grams in order, and ranks by language and n-gram; a last column stands for n-grams in no profile."""
    found = table.limit(MOST_LANGUAGES * PROFILE + 1).collect()
    langs = sorted({r.lang for r in found})
    if len(langs) > MOST_LANGUAGES or len(found) > MOST_LANGUAGES * PROFILE:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    known = np.array(sorted({r.gram for r in found}), np.int64)
    ranks = np.full((len(langs), len(known) + 1), -1, np.int32)
    at = {lang: i for i, lang in enumerate(langs)}
    for r in found:
        ranks[at[r.lang], np.searchsorted(known, r.gram)] = r.place
    return langs, known, ranks


def rank(text: str | None, langs: list[str], known: np.ndarray, ranks: np.ndarray, length: int) -> tuple[str, float]:
    """The language with the least out-of-place distance, and 1 less that distance's share of the largest possible one."""
    found, counts = np.unique(grams(text), return_counts=True)
    if not len(found) or not langs:
        return UNKNOWN, 0.0
    if len(found) > length:  # none below the count of the last place can be in the list
        few = counts >= np.partition(counts, -length)[-length]
        found, counts = found[few], counts[few]
    listed = found[np.argsort(-counts, kind="stable")][:length]
    at = np.searchsorted(known, listed)
    at[at < len(known)] = np.where(known[at[at < len(known)]] == listed[at < len(known)], at[at < len(known)], len(known))
    place = ranks[:, at]
    apart = np.where(place < 0, length, np.abs(place - np.arange(len(listed)))).sum(axis=1)
    best = int(apart.argmin())
    return langs[best], float(1 - apart[best] / (length * len(listed)))


def identify(docs: DataFrame, table: DataFrame, length: int = PROFILE) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs`` (``doc_id``, ``text``); score is 1 for a profile's own list."""
    model = docs.sparkSession.sparkContext.broadcast(load(table))

    def predict(source: Iterator[tuple]) -> Iterator[list]:
        for held in blocks(source, 1):
            yield [[r[0] for r in held], *columns([rank(text, *model.value, length) for _, text in held])]

    return map_batches(docs.select("doc_id", "text"), predict, "doc_id long, lang_pred string, score double")


def recognised(docs: DataFrame, table: DataFrame, length: int = PROFILE) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which a language is found; nothing is shuffled."""
    model = docs.sparkSession.sparkContext.broadcast(load(table))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in by_size(batches, "text", 4_000_000):
            good = [rank(text, *model.value, length)[0] != UNKNOWN for text in block.column("text").to_pylist()]
            yield block.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
