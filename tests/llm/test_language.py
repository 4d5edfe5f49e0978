import re
from collections import Counter

from polyad.llm import language

from .conftest import ODD

TEXTS = {"aa": ["the cat and the dog sat on the mat", "the house and the tree"], "bb": ["der hund und die katze", "das haus und der baum und die stadt"]}


def reference_grams(text):
    out = Counter()
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        word = f" {word} "
        out.update(g for n in (1, 2, 3) for i in range(len(word) - n + 1) if (g := word[i : i + n]) != " ")
    return out


def reference_rank(counts):
    return sorted(counts, key=lambda g: (-counts[g], sum(ord(c) << 21 * k for k, c in enumerate(reversed(g)))))


def test_grams_match_the_definition():
    for text in [*filter(None, ODD[:7]), "A b, cd! ?ef", "x1y 2", "  lead and trail  "]:
        assert Counter(map(language.gram_text, language.grams(text).tolist())) == reference_grams(text)


def test_profiles_and_predictions_match_brute_force(docs_of):
    rows = [(10 * i + k, t, lang, "s") for i, (lang, ts) in enumerate(TEXTS.items()) for k, t in enumerate(ts)]
    rows += [(100, "untaught words", None, "s"), (101, None, "aa", "s")]
    table = language.profiles(docs_of(rows), length=30)
    lists = {}
    for r in table.collect():
        lists.setdefault(r.lang, {})[r.place] = language.gram_text(r.gram)
    for lang, texts in TEXTS.items():
        expected = reference_rank(sum((reference_grams(t) for t in texts), Counter()))[:30]
        assert [lists[lang][i] for i in range(len(expected))] == expected
    asked = [(1, "the mat and the tree"), (2, "die stadt und der baum"), (3, None), (4, "123 !!"), (5, "und"), (5, "und")]
    for doc_id, pred, score in language.identify(docs_of(asked), table, 30).collect():
        text = dict(asked)[doc_id]
        mine = reference_rank(reference_grams(text or ""))[:30]
        if not mine:
            assert (pred, score) == (language.UNKNOWN, 0.0)
            continue
        place = {lang: {g: i for i, g in of.items()} for lang, of in lists.items()}
        apart = {lang: sum(abs(p[g] - i) if g in p else 30 for i, g in enumerate(mine)) for lang, p in place.items()}
        assert pred == min(apart, key=lambda x: (apart[x], x))
        assert abs(score - (1 - apart[pred] / (30 * len(mine)))) < 1e-9


def test_odd_texts_ties_and_empty_tables(docs_of):
    table = language.profiles(docs_of([(1, "abc", "zz", "s"), (2, "abc", "yy", "s")]))
    found = language.identify(docs_of([*enumerate(ODD), (None, "abc")]), table).collect()
    assert len(found) == len(ODD) + 1 and {r.lang_pred for r in found} <= {"yy", "und"}  # equal distances: the first by name
    empty = docs_of([]).limit(0)
    assert language.profiles(empty).count() == 0
    assert language.identify(empty, table).count() == 0
    assert language.identify(docs_of([(1, "abc")]), language.profiles(empty)).collect()[0][1:] == ("und", 0.0)
