"""License scans with a positional index of rare words.

The index has the words of all license templates with their postings (template,
position). The words' inverse document frequencies come from the whole corpus. Of each
file's words in a template, the ones with the highest IDF are looked up, as many as it takes
until the others together could not reach the wanted score; a posting of a place of such
a word proposes where the template would begin. There the postings of all the template's
words are intersected by relative position: a word counts if it stands within
``slack`` words of where it should. The score is the matched share of the template's IDF
(each place of a word counts), the best over all beginnings; none is missed, because a
beginning with the wanted score has a looked-up word within ``slack`` of its place, and
all beginnings that close to a proposed one are tried. Last, the template's mandatory key
phrases must stand in the stretch that the template covers.

A template that is ``exact`` must match word for word: its score is 1 or 0, its one looked-up
word is the one with the highest IDF, and all its places are counted.

Edge cases: words are runs of ASCII letters and digits, A-Z lower-cased, and of all
other characters beyond ASCII. A NULL or empty text has no words and no match. Rows that
repeat are scanned each, and each counts for the frequencies. Without rows, the result is
empty. Of a template's equally good places the first is given; among words of one IDF the
one that sorts first is looked up first, which changes no result. Columns beyond
``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, map_batches, tidy
from .common import rows as unpacked
from .decontaminate import split

LEAST = 0.8  # score from which a template counts
SLACK = 3  # words that a word may be off its place
BATCH = 4096  # beginnings tried at once


class Template(NamedTuple):
    label: str
    text: str
    keys: tuple[str, ...] = ()
    exact: bool = False


# The base phrases, and the public standard notices with the phrases that tell them apart
BASE = (
    Template("mit", "under the mit license", exact=True),
    Template("apache-2", "apache license version 2", exact=True),
    Template("cc-by-nc", "cc by nc", exact=True),
)
_GNU = "this program is free software you can redistribute it and or modify it under the terms of the {} as published by the free software foundation either version {} of the license or at your option any later version"
_CC = "this work is licensed under a creative commons {} international license"
TEMPLATES = BASE + (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ("free of charge", "without restriction")),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at", ("apache license", "in compliance with the license")),
    Template("gpl-3", "licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    Template("gpl-2", "licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    Template("gpl-3", _GNU.format("gnu general public license", 3), ("gnu general public license", "version 3")),
    Template("gpl-2", _GNU.format("gnu general public license", 2), ("gnu general public license", "version 2")),
    Template("lgpl-3", _GNU.format("gnu lesser general public license", 3), ("gnu lesser general public license", "version 3")),
    Template("agpl-3", _GNU.format("gnu affero general public license", 3), ("gnu affero general public license", "version 3")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("source and binary forms", "following conditions")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", ("with or without fee", "appear in all copies")),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at", ("mozilla public license",)),
    Template("epl-2", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at", ("eclipse public license",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software", ("free and unencumbered software",)),
    Template("cc-by", _CC.format("attribution 4 0"), ("creative commons attribution 4",)),
    Template("cc-by-sa", _CC.format("attribution sharealike 4 0"), ("attribution sharealike",)),
    Template("cc-by-nc", _CC.format("attribution noncommercial 4 0"), ("attribution noncommercial 4",)),
    Template("cc-by-nc-sa", _CC.format("attribution noncommercial sharealike 4 0"), ("attribution noncommercial sharealike",)),
)


class Index:
    """Templates as word numbers from 1 on, in order of their words; 0 stands for all other words."""

    def __init__(self, templates: tuple[Template, ...]):
        self.templates = templates
        words = [split(t.text) for t in templates]
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for t in words for w in t}), 1)}
        self.words = [np.array([self.vocabulary[w] for w in t], np.int64) for t in words]
        self.keys = [[np.array([self.vocabulary.get(w, -1) for w in split(k)], np.int64) for k in t.keys] for t in templates]
        self.postings = [{int(w): np.flatnonzero(t == w) for w in np.unique(t)} for t in self.words]

    def numbered(self, held: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        """A block's words by number, and where each text's begin."""
        flat: list[bytes] = []
        starts = [0]
        for row in held:
            flat += split(row[1])
            starts.append(len(flat))
        return np.fromiter(map(self.vocabulary.get, flat, repeat(0)), np.int64, len(flat)), np.array(starts)

    def present(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Which words each text has."""
        at = np.flatnonzero(words)
        out = np.zeros((len(starts) - 1, len(self.vocabulary) + 1), bool)
        out[np.searchsorted(starts, at, side="right") - 1, words[at]] = True
        return out


def frequencies(docs: DataFrame, index: Index) -> np.ndarray:
    """The number of documents, and of those with each word of the index: as many rows as it has words, summed over the whole corpus."""

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(index.vocabulary) + 1, np.int64)
        for held in blocks(unpacked(batches), 1):
            sums += index.present(*index.numbered(held)).sum(axis=0)
            sums[0] += len(held)
        yield pa.record_batch({"word": np.arange(len(sums)), "n": sums})

    found = docs.select("doc_id", "text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(len(index.vocabulary) + 1, np.int64)
    for r in found:
        out[r.word] = r.n
    return out


def rarity(counts: np.ndarray) -> np.ndarray:
    """IDF from :func:`frequencies`; at least 1, so that every word has some weight."""
    return np.log((counts[0] + 1) / (counts + 1)) + 1


def lookups(template: np.ndarray, present: np.ndarray, idf: np.ndarray, least: float) -> np.ndarray:
    """Of a file's words in a template, those with the highest IDF, until the others cannot reach ``least``; none if all cannot."""
    words, times = np.unique(template, return_counts=True)
    weight = idf[words] * times * present[words]
    order = np.lexsort((words, -idf[words]))
    order = order[present[words][order]]
    need = least * idf[template].sum() - 1e-9
    rest = weight.sum() - np.concatenate([[0.0], np.cumsum(weight[order])])
    return words[order[: int((rest >= need).sum())]]


def matched(template: np.ndarray, words: np.ndarray, begin: np.ndarray, slack: int) -> np.ndarray:
    """For every beginning, which of the template's words stand within ``slack`` of their place."""
    margin = len(template) + 2 * slack
    padded = np.concatenate([np.zeros(margin, np.int64), words, np.zeros(margin, np.int64)])
    hit = np.zeros((len(begin), len(template)), bool)
    at = begin[:, None] + np.arange(len(template)) + margin
    for shift in range(-slack, slack + 1):
        hit |= padded[at + shift] == template
    return hit


def contains(words: np.ndarray, phrase: np.ndarray) -> bool:
    n = len(words) - len(phrase) + 1
    good = np.ones(max(n, 0), bool)
    for i, word in enumerate(phrase):
        good &= words[i : i + n] == word
    return bool(good.any())


def places(index: Index, number: int, words: np.ndarray, ask: np.ndarray, idf: np.ndarray, least: float, slack: int) -> tuple[int, int, int, float] | None:
    """How many places a template has in a file, the first, the last and the best one's score; for an inexact template only the best place."""
    template = index.words[number]
    if index.templates[number].exact:
        slack, least = 0, 1.0
    proposed = [np.flatnonzero(words == w)[:, None] - index.postings[number][int(w)] for w in ask]
    begin = np.unique(np.concatenate([p.ravel() for p in proposed])[:, None] + np.arange(-slack, slack + 1))
    begin = begin[(begin > -len(template) - slack) & (begin < len(words) + slack)]
    share = idf[template] / idf[template].sum()
    good: list[tuple[float, int]] = []
    for i in range(0, len(begin), BATCH):
        part = begin[i : i + BATCH]
        hit = matched(template, words, part, slack)
        score = np.where(hit.all(axis=1), 1.0, hit @ share)
        for k in np.flatnonzero(score >= least - 1e-9).tolist():
            stretch = words[max(part[k] - slack, 0) : max(part[k] + len(template) + slack, 0)]
            if all(contains(stretch, key) for key in index.keys[number]):
                good.append((float(score[k]), -int(part[k])))
    if not good:
        return None
    if index.templates[number].exact:
        return len(good), -good[0][1], -good[-1][1], 1.0
    score, at = max(good)
    return 1, max(-at, 0), max(-at, 0), min(score, 1.0)


_MATCHES = "array<struct<label:string, template:int, exact:boolean, places:long, first:long, last:long, score:double>>"


def find(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, least: float = LEAST, slack: int = SLACK) -> DataFrame:
    """``doc_id, n_words, matches`` for every row of ``docs``; a match has a template's label and number, its places and its score."""
    index = Index(templates)
    idf = rarity(frequencies(docs, index))

    def run(source: Iterator[tuple]) -> Iterator[list]:
        for held in blocks(source, 1):
            words, starts = index.numbered(held)
            present = index.present(words, starts)
            out: list[list[dict]] = [[] for _ in held]
            for number, template in enumerate(index.words):
                exact = index.templates[number].exact
                weight = present[:, template] @ idf[template]
                able = present[:, template].all(axis=1) if exact else weight >= least * idf[template].sum() - 1e-9
                for doc in np.flatnonzero(able).tolist():
                    ask = lookups(template, present[doc], idf, 1.0 if exact else least)
                    found = places(index, number, words[starts[doc] : starts[doc + 1]], ask, idf, least, slack)
                    if found:
                        n, first, last, score = found
                        out[doc].append({"label": index.templates[number].label, "template": number, "exact": exact, "places": n, "first": first, "last": last, "score": score})
            yield [[r[0] for r in held], np.diff(starts).tolist(), out]

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id long, n_words long, matches {_MATCHES}")


def digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` for every row of ``docs``."""
    exact = F.filter("matches", lambda m: m["exact"])
    of = lambda found, field: F.transform(found, lambda m: m[field])
    listed = lambda found: F.array_join(F.array_sort(F.array_distinct(of(found, "label"))), ",")
    return find(docs).select(
        "doc_id", "n_words", F.aggregate(of(exact, "places"), F.lit(0).cast("long"), lambda a, b: a + b).alias("n_base"),
        F.array_min(of(exact, "first")).alias("first_word"), F.array_max(of(exact, "last")).alias("last_word"),
        listed(exact).alias("base_labels"), listed(F.col("matches")).alias("labels"), F.coalesce(F.array_max(of(F.col("matches"), "score")), F.lit(0.0)).alias("score"),
    )
