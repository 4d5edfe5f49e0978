import math
import re

import numpy as np
import pytest

from polyad.llm import licenses as lc

from .conftest import ODD


def words_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def by_hand(rows, templates, least, slack):
    """Every template at every beginning in every text."""
    texts = [words_of(t) for _, t in rows]
    idf = lambda w: math.log((len(rows) + 1) / (sum(w in t for t in texts) + 1)) + 1
    weight = {w: idf(w) for t in templates for w in words_of(t.text)}
    out = []
    for (doc_id, _), words in zip(rows, texts, strict=True):
        matches = []
        for number, t in enumerate(templates):
            wanted = words_of(t.text)
            off = 0 if t.exact else slack
            at = lambda i: words[i] if 0 <= i < len(words) else None
            best, places = 0.0, []
            for begin in range(-len(wanted) - off, len(words) + off):
                got = [w for k, w in enumerate(wanted) if any(at(begin + k + d) == w for d in range(-off, off + 1))]
                score = sum(weight[w] for w in got) / sum(weight[w] for w in wanted)
                stretch = " " + " ".join(words[max(begin - off, 0) : max(begin + len(wanted) + off, 0)]) + " "
                if score >= (1.0 if t.exact else least) - 1e-9 and all(f" {k} " in stretch for k in t.keys):
                    places.append(begin)
                    best = max(best, score)
            if places:
                matches.append((t.label, number, t.exact, len(places) if t.exact else 1, round(best, 9), (places[0], places[-1]) if t.exact else None))
        out.append((doc_id, len(words), matches))
    return out


def found_in(docs, **how):
    out = []
    for r in lc.find(docs, **how).collect():
        out.append((r.doc_id, r.n_words, [(m.label, m.template, m.exact, m.places, round(m.score, 9), (m.first, m.last) if m.exact else None) for m in r.matches]))
    return out


@pytest.fixture
def rows(prose):
    rng = np.random.default_rng(3)
    own = []
    for k, t in enumerate(lc.TEMPLATES):
        words = t.text.split()
        cut = [w for w in words if rng.random() > 0.1]
        swapped = [w if rng.random() > 0.15 else "thing" for w in words]
        more = [x for w in words for x in ([w, "indeed"] if rng.random() < 0.08 else [w])]
        for j, version in enumerate((words, cut, swapped, more, words[: len(words) // 2], words[::-1])):
            own.append((100 + 10 * k + j, prose(k, 20) + ". " + ", ".join(version).upper() + "; " + prose(j, 15)))
    own += [(i, prose(i, 40)) for i in range(20)]
    own += [(60, "Released under the MIT-License. under the mit license " * 3), (61, "cc by-nc cc by nc cc cc by nc"), (62, "the license of the software " * 200), (None, "CC BY-NC"), (60, "twice"), (63, "Under the MIT"), (64, "under the mit licenses")]
    return own + [(900 + i, t) for i, t in enumerate(ODD)]


@pytest.mark.parametrize(("least", "slack"), [(lc.LEAST, lc.SLACK), (0.5, 1), (0.9, 0)])
def test_matches_brute_force(docs_of, rows, least, slack):
    rows = [r for r in rows if len(r[1] or "") < 6000]
    want = by_hand(rows, lc.TEMPLATES, least, slack)
    found = found_in(docs_of(rows), least=least, slack=slack)
    assert sorted(map(str, found)) == sorted(map(str, want))
    inexact = [m for _, _, matches in want for m in matches if not m[2]]
    assert any(m[4] < 1 for m in inexact) and any(m[4] == 1 for m in inexact) or least == 0.9


def test_digest(docs_of, rows):
    found = {(r.doc_id, r.n_words): r for r in lc.digest(docs_of(rows)).collect()}
    assert len(found) == len(rows)
    for doc_id, text in rows:
        words = words_of(text)
        r = found[doc_id, len(words)]
        hits = {t.label: [i for i in range(len(words)) if words[i : i + len(t.text.split())] == t.text.split()] for t in lc.BASE}
        every = [i for h in hits.values() for i in h]
        assert (r.n_base, r.first_word, r.last_word) == (len(every), min(every, default=None), max(every, default=None))
        assert r.base_labels == ",".join(sorted(k for k, h in hits.items() if h))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert (r.score > 0) == bool(r.labels) and 0 <= r.score <= 1


def test_lookups_take_the_rarest_words_first():
    template = np.array([1, 2, 3, 4])
    idf = np.array([0, 1.0, 5.0, 2.0, 4.0])
    present = np.array([False, True, True, True, True])
    assert lc.lookups(template, present, idf, 1.0).tolist() == [2]
    assert lc.lookups(template, present, idf, 0.5).tolist() == [2, 4]
    present[2] = False
    assert lc.lookups(template, present, idf, 0.5).tolist() == [4]
    assert lc.lookups(template, present, idf, 0.8).tolist() == []


def test_key_phrases_are_mandatory(docs_of):
    text = lc.TEMPLATES[7].text
    labels = lambda t: next(r.labels for r in lc.digest(docs_of([(1, t), (2, "other words")])).collect() if r.doc_id == 1)
    assert labels(text) == "gpl-3"
    assert labels(text.replace("version 3", "version 4")) == ""


def test_empty_table(docs_of):
    assert lc.digest(docs_of([]).limit(0)).count() == 0
