import random
from itertools import combinations

import pytest

from polyad.llm import neardup


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= 75 * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least.setdefault(find(i), []).append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [d for d in least[find(i)] if d is not None]
        component = min(ids) if ids and sets[i] else doc_id
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return sorted(out, key=str)


def found(docs):
    return sorted((tuple(r) for r in neardup.near_duplicates(docs).collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    out = [" ".join(text(rng.randint(5, 120))) for _ in range(40)]
    base = text(120)
    for _ in range(60):  # a large group of near copies
        copy = list(base)
        copy[rng.randrange(120)] = rng.choice(vocabulary)
        out.append(" ".join(copy))
    chain = text(200)
    for _ in range(8):  # each near the one before, the last far from the first
        at = rng.randrange(190)
        chain = [*chain[:at], *text(3), *chain[at + 3 :]]
        out.append(" ".join(chain))
    passage = text(40)
    out += [" ".join(text(60) + passage) for _ in range(30)]  # a shared passage is no near copy
    out += [out[0]] * 25 + [out[0].upper(), "few words", "FEW  words", "few", "", None, " \n", None, "café Ünï 漢字 a b c", "a" * 3000]
    rows = list(enumerate(out, 10))
    rng.shuffle(rows)
    return rows


def test_components_match_brute_force(docs_of, rows):
    assert found(docs_of(rows, 5)) == expected(rows)


def test_repeated_rows_null_ids_and_empty_tables(docs_of):
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (None, "lone text here of six words"), (5, None), (5, "")]
    assert found(docs_of(rows)) == expected(rows)
    assert found(docs_of([]).limit(0)) == []
    assert found(docs_of([(1, None), (2, "")])) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_components_of_a_long_chain_and_a_hub(spark, docs_of):
    docs_of([])
    pairs = [(i + 1, i) for i in range(60)] + [(1000 + i, 999) for i in range(50)] + [(7, 7)]
    roots = {r.node: r.root for r in neardup.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert all(roots[i] == 0 for i in range(1, 61)) and all(roots[1000 + i] == 999 for i in range(50)) and 0 not in roots


@pytest.mark.parametrize("seed", range(2))
def test_components_of_added_links(spark, docs_of, seed):
    docs_of([])
    rng = random.Random(seed)
    draw = lambda n: [(rng.randrange(200), rng.randrange(200)) for _ in range(n)]
    groups = [draw(90), draw(30), [], draw(40) + [(300 + i, 500 - i) for i in range(60)]]
    roots, seen = None, []
    for group in groups:
        seen += group
        roots = neardup.components(spark.createDataFrame(group, "u long, v long"), roots)
        least = {i: i for pair in seen for i in pair}
        for _ in least:  # the smallest number reached, link by link
            for u, v in seen:
                least[u] = least[v] = min(least[u], least[v])
        assert {r.node: r.root for r in roots.collect()} == {i: r for i, r in least.items() if i != r}


def test_many_comparisons_with_one_node_are_split(spark, docs_of, monkeypatch):
    import numpy as np

    docs_of([])
    monkeypatch.setattr(neardup, "SPLIT", 4)
    data = lambda x: bytearray(np.array(sorted(x), np.uint64).tobytes())
    sets = spark.createDataFrame([(0, data(range(100)))] + [(i, data(range(i, 100 + i))) for i in range(1, 40)], "node long, shingles binary")
    pairs = spark.createDataFrame([(i, 0) for i in range(1, 40)], "x long, y long")
    kept = {r.u for r in neardup.confirm(pairs, sets, 75).collect()}
    assert kept == {i for i in range(1, 40) if 100 * (100 - i) >= 75 * (100 + i)}
