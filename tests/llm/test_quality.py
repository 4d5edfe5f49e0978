import random

import numpy as np

from polyad.llm import quality

from .conftest import ODD


def corpus(n):
    rng = random.Random(6)
    words = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("ar", "en", "ill", "ond", "ush")]
    good = lambda: ". ".join(" ".join(rng.choice(words) for _ in range(rng.randint(5, 12))).capitalize() for _ in range(rng.randint(2, 9)))
    bad = [lambda: " ".join(rng.choice(words).upper() + "!!" for _ in range(40)), lambda: (rng.choice(words) + " ") * 60, lambda: " ".join(rng.choice(words) + "%%%" for _ in range(50))]
    return [(i, good(), 1) if rng.random() < 0.6 else (i, rng.choice(bad)(), 0) for i in range(n)]


def test_held_out_labels_are_predicted(spark, docs_of):
    rows = corpus(300)
    docs = docs_of([r[:2] for r in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 3], "doc_id long, quality int")
    found = {r.doc_id: r for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    held = [(found[i], y) for i, _, y in rows if i % 3 == 0]
    assert np.mean([r.predicted == y for r, y in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r, _ in held)


def test_pairs_learn_what_single_measures_cannot():
    rng = np.random.default_rng(2)
    x = np.pad(rng.random((3000, 2)), ((0, 0), (0, 1)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.Additive().fit(x[:2000], y[:2000])
    assert ((model.predict(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.9
    assert (quality.Additive(pairs=0).fit(x[:2000], y[:2000]).predict(x[2000:]) >= 0.5).mean() < 1


def test_odd_texts_odd_labels_and_empty_tables(spark, docs_of):
    docs = docs_of([*enumerate(ODD), (0, "again"), (None, "no id")])
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int")
    for rows in ([], [(0, None), (None, 1)], [(0, 1), (1, 1)], [(0, 0), (0, 1), (1, 1), (2, 0), (99, 1)]):
        found = quality.score(docs, quality.fit(docs, labels(rows))).collect()
        assert len(found) == len(ODD) + 2 and all(0 <= r.score <= 1 for r in found)
    assert quality.score(docs.limit(0), quality.Additive().fit(np.zeros((0, 22)), np.zeros(0))).count() == 0


def test_sample_is_bounded(spark, docs_of):
    rows = corpus(60)
    docs = docs_of([r[:2] for r in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    assert quality.fit(docs, labels, most=0).tables == [] and quality.fit(docs, labels, most=40).tables
    assert len(quality.MEASURES) == len(quality.measure("some text"))


def plain_boosting(x, y, bins=32, coarse=8, rounds=3, pair_rounds=2, most_pairs=8, rate=0.1, depth=2, ridge=5.0):
    """The additive model row by row and cut by cut: a function from measures to a score."""
    columns = range(x.shape[1])
    edges = {n: [sorted(set(np.quantile(x[:, k], np.arange(1, n) / n).tolist())) for k in columns] for n in (bins, coarse)}
    bin_of = lambda n, k, v: sum(v >= e for e in edges[n][k])
    base = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    steps = []  # functions of a row, added up
    scores = [base] * len(y)

    def sums(key):
        g, h = {}, {}
        for row, label, s in zip(x, y, scores):
            p = 1 / (1 + np.exp(-s))
            g[key(row)] = g.get(key(row), 0) + label - p
            h[key(row)] = h.get(key(row), 0) + p * (1 - p)
        return g, h

    part = lambda d, cells: sum(d.get(c, 0) for c in cells)
    value = lambda g, h, cells: part(g, cells) / (part(h, cells) + ridge)
    worth = lambda g, h, cells: part(g, cells) ** 2 / (part(h, cells) + ridge)

    def tree(g, h, cells, depth):
        if depth == 0 or len(cells) < 2:
            return {c: value(g, h, cells) for c in cells}
        gains = [worth(g, h, cells[:i]) + worth(g, h, cells[i:]) for i in range(1, len(cells))]
        i = int(np.argmax(gains)) + 1
        return tree(g, h, cells[:i], depth - 1) | tree(g, h, cells[i:], depth - 1)

    def quarters(g, h, rows, cols):
        best = None
        for i in range(1, rows):
            for j in range(1, cols):
                parts = [[(a, b) for a in A for b in B] for A in (range(i), range(i, rows)) for B in (range(j), range(j, cols))]
                gain = sum(worth(g, h, p) for p in parts)
                if best is None or gain > best[0] + 1e-12:
                    best = gain, parts
        every = [c for p in best[1] for c in p]
        return best[0] - worth(g, h, every), {c: value(g, h, p) for p in best[1] for c in p}

    def add(key, table):
        steps.append((key, table))
        for n, row in enumerate(x):
            scores[n] += rate * table[key(row)]

    for _ in range(rounds):
        for k in columns:
            key = lambda row, k=k: bin_of(bins, k, row[k])
            add(key, tree(*sums(key), list(range(len(edges[bins][k]) + 1)), depth))
    pair_key = lambda i, j: lambda row: (bin_of(coarse, i, row[i]), bin_of(coarse, j, row[j]))
    size = lambda k: len(edges[coarse][k]) + 1
    split = [k for k in columns if size(k) > 1]
    gains = sorted(((quarters(*sums(pair_key(i, j)), size(i), size(j))[0], i, j) for a, i in enumerate(split) for j in split[a + 1 :]), reverse=True)
    for _ in range(pair_rounds):
        for _, i, j in gains[:most_pairs]:
            add(pair_key(i, j), quarters(*sums(pair_key(i, j)), size(i), size(j))[1])
    return lambda row: 1 / (1 + np.exp(-base - rate * sum(table.get(key(row), 0) for key, table in steps)))


def test_boosting_matches_a_plain_version():
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(120, 4)), 2)
    x[:, 3] = 1.0  # a measure without variation
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] * x[:, 2] > 0.2)).astype(float)
    model = quality.Additive(rounds=3, pair_rounds=2).fit(x, y)
    plain = plain_boosting(x, y)
    new = np.vstack([x, np.round(rng.normal(size=(30, 4)), 2)])
    assert np.allclose(model.predict(new), [plain(row) for row in new], atol=1e-9)


def test_order_and_repeats_do_not_change_the_model(spark, docs_of, prose):
    rows = [(i, prose(i, 30) if i % 2 else "!!! $$$ | 12 " * i) for i in range(60)]
    rows += [(i, "another text of the same number " * i) for i in range(0, 60, 7)] + rows[:5]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    scores = [sorted((r.doc_id, round(r.score, 12)) for r in quality.score(docs, quality.fit(docs, labels)).collect()) for docs in (docs_of(rows, 1), docs_of(rows[::-1], 1), docs_of(rows, 7))]
    assert scores[0] == scores[1] == scores[2]
    few = quality.fit(docs_of(rows), labels, most=20)
    assert few.base != quality.fit(docs_of(rows), labels).base
