import random

from polyad.llm import decontaminate as dc

from .conftest import ODD


def brute(rows, items, least):
    """Every pair whose best alignment, by the textbook recurrence, reaches the score and is worth three matches or the whole item."""
    out = {}
    for doc_id, text in rows:
        words = dc.split(text)
        for item_id, other in items:
            wanted = dc.split(other)
            best, row = 0.0, [0.0] * (len(words) + 1)
            for w in wanted:
                new = [0.0]
                for j, x in enumerate(words):
                    new.append(max(0.0, row[j] + (1 if w == x else -0.5), row[j + 1] - 0.5, new[j] - 0.5))
                best, row = max(best, *new), new
            if wanted and best >= max(least * len(wanted), min(len(wanted), 3)) - 1e-9:
                out[doc_id, item_id] = best / len(wanted)
    return out


def case(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)] + ["the", "of", "and"] * 40
    text = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i, " ".join(text(rng.randint(20, 50)))) for i in range(12)] + [(50, "two words"), (51, ""), (52, None), (53, "the of and the of and"), (None, " ".join(text(30)))]
    rows = [(i, " ".join(text(80))) for i in range(30)]
    for k, (_, item) in enumerate(items[:12]):
        for rate in (0, 0.15, 0.3):
            copy = [w if rng.random() >= rate else rng.choice(words) for w in item.split()]
            rows.append((100 + 10 * k + int(rate * 20), " ".join(text(30) + copy + text(30)).replace(" w1", ", W1")))
    rows += [(900, items[0][1] + " " + items[0][1]), (901, "has Two, WORDS inside"), *((1000 + i, t) for i, t in enumerate(ODD))]
    return rows, items, spark.createDataFrame([(i, t, 0.5) for i, t in items], "item_id long, text string, score double")


def test_pairs_match_brute_force(spark, docs_of):
    rows, items, benchmark = case(spark)
    want = brute(rows, items, dc.LEAST)
    found = {(r.doc_id, r.item_id): r.score for r in dc.find(docs_of(rows), benchmark).collect()}
    assert found.keys() == want.keys()
    assert all(abs(found[k] - want[k]) < 1e-9 for k in want)


def test_chunks_do_not_change_the_result(spark, docs_of):
    rows, _, benchmark = case(spark)
    docs = docs_of(rows[:60])
    assert sorted(map(str, dc.find(docs, benchmark, chunk=200).collect())) == sorted(map(str, dc.find(docs, benchmark).collect()))


def test_frequent_seeds_do_not_hide_a_copy(spark, docs_of):
    passage = "a passage that very many documents share word for word here"
    rows = [(i, f"own{i} {passage} tail{i}") for i in range(60)]
    benchmark = spark.createDataFrame([(1, passage)], "item_id long, text string")
    assert dc.find(docs_of(rows), benchmark).count() == 60


def test_a_common_edited_or_partial_copy_is_found(spark, docs_of):
    item = [f"q{i}" for i in range(40)]
    edited = lambda d: " ".join(f"own{d}x{i}" if i % 4 == 3 else w for i, w in enumerate(item))
    texts = {"edited": lambda d: edited(d), "part": lambda d: " ".join([f"a{d}", *item[:18], f"b{d}"]), "apart": lambda d: " ".join([*item[:14], *(f"z{d}x{i}" for i in range(24)), *item[26:]])}
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    for n in (17, 100, 1000):
        rows = [(d * 10 + k, make(d)) for d in range(n) for k, make in enumerate((texts["edited"], texts["part"]))]
        found = {r.doc_id: r.score for r in dc.find(docs_of(rows), benchmark).collect()}
        assert len(found) == 2 * n
        want = brute(rows[:2], [(1, " ".join(item))], dc.LEAST)
        assert all(abs(found[d * 10 + k] - want[k, 1]) < 1e-9 for d in range(n) for k in range(2))
    rows = [(d, texts["apart"](d)) for d in range(20)]
    assert {(r.doc_id, r.item_id) for r in dc.find(docs_of(rows), benchmark).collect()} == brute(rows, [(1, " ".join(item))], dc.LEAST).keys()


def test_copies_without_three_words_in_a_row(spark, docs_of):
    item = [f"q{i}" for i in range(42)]
    edits = {
        "third": lambda d: [f"own{d}x{i}" if i % 3 == 2 else w for i, w in enumerate(item)],
        "gaps": lambda d: [x for i, w in enumerate(item) for x in ([w, f"own{d}x{i}"] if i % 2 else [w])],
        "between": lambda d: [x for i, w in enumerate(item) for x in (w, f"own{d}x{i}")],
        "left": lambda d: [w for i, w in enumerate(item) if i % 3 != 2],
    }
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    for n in (1, 17, 1000):
        rows = [(d * 10 + k, f"before{d} " + " ".join(make(d)) + f" after{d}") for d in range(n) for k, make in enumerate(edits.values())]
        found = {r.doc_id: r.score for r in dc.find(docs_of(rows), benchmark).collect()}
        want = brute(rows[:4], [(1, " ".join(item))], dc.LEAST)
        assert len(want) == 4 and len(found) == 4 * n
        assert all(abs(found[d * 10 + k] - want[k, 1]) < 1e-9 for d in range(n) for k in range(4))


def test_random_edits_match_alignment_alone(spark, docs_of):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 12, 20])))) for i in range(60)]
    rows = []
    for d in range(150):
        copy = [w for w in rng.choice(items)[1].split() if rng.random() > 0.2 for w in ([w, rng.choice(words)] if rng.random() < 0.3 else [w])]
        rows.append((d, " ".join([rng.choice(words) for _ in range(15)] + [w if rng.random() > 0.2 else "new" for w in copy] + [rng.choice(words) for _ in range(15)])))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.score for r in dc.find(docs_of(rows), benchmark).collect()}
    want = brute(rows, items, dc.LEAST)
    assert found.keys() == want.keys() and all(abs(found[k] - want[k]) < 1e-9 for k in want)


def test_a_large_benchmark_of_common_words(spark, docs_of):
    rng = random.Random(8)
    words = [f"c{i}" for i in range(300)]
    text = lambda n: rng.choices(words, k=n)
    items = [(i, " ".join(text(30))) for i in range(20_000)]
    rows = [(d, " ".join(text(60) + items[d * 100][1].split() + text(60)) if d % 2 else " ".join(text(150))) for d in range(40)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.score for r in dc.find(docs_of(rows), benchmark).collect()}
    assert all(found[d, d * 100] == 1.0 for d in range(1, 40, 2))
    some = rows[:4]
    want = brute(some, items[:400], dc.LEAST)
    assert {k: round(v, 9) for k, v in found.items() if k[0] < 4 and k[1] < 400} == {k: round(v, 9) for k, v in want.items()}


def test_rows_pass_with_all_their_columns(spark, docs_of):
    rows, items, benchmark = case(spark)
    docs = docs_of(rows)
    hit = {d for d, _ in brute(rows, items, dc.LEAST)}
    left = dc.without_copies(docs, benchmark, chunk=200)
    assert left.columns == docs.columns
    assert sorted(map(str, left.collect())) == sorted(str(r) for r in docs.collect() if r.doc_id not in hit)
    assert "Exchange" not in left._jdf.queryExecution().executedPlan().toString().split("Scan ExistingRDD")[0].split("Exchange RoundRobin")[0]


def test_empty_tables(spark, docs_of):
    _, _, benchmark = case(spark)
    assert dc.find(docs_of([]).limit(0), benchmark).count() == 0
    assert dc.find(docs_of([(1, "x y z")]), benchmark.limit(0)).count() == 0
