import hashlib

import pytest

from polyad.llm import fim

from .conftest import ODD


def by_hand(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return "plain", text, None, None
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    return ("spm", f"<S>{s}<P>{p}<M>{m}", a, b - a) if h4 % 100 < 20 else ("psm", f"<P>{p}<S>{s}<M>{m}", a, b - a)


def rows(prose):
    marks = ["<", "<P", "<P>", "P>S>M><", "<<S>", "<" * 50, "<P" * 40 + "S>" * 40, "a<M>b"]
    texts = [*ODD, *marks, *(prose(i, 5 + 7 * i) for i in range(40)), "\U0001f600é漢" * 3000]
    return [(i, t) for i, t in enumerate(texts)] + [(None, "no number"), (None, "no number"), (None, None), (3, "other text"), (3, "other text"), (-7, prose(1, 30))]


@pytest.mark.parametrize("chunk", [1, 7, fim.CHUNK])
def test_outputs_and_digests(docs_of, prose, chunk):
    cases = [(d, t) for d, t in rows(prose) if chunk > 1 or len(t or "") < 500]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for doc_id, text in cases:
        form, output, prefix, middle = by_hand(doc_id, text)
        want.append((doc_id, len(text or ""), form, prefix, middle, sha(output), sha(text or "")))
    found = [tuple(r) for r in fim.digest(docs_of(cases), chunk=chunk).collect()]
    assert sorted(map(str, found)) == sorted(map(str, want))
    assert {form for _, _, form, *_ in want} == {"plain", "psm", "spm"}


def test_outputs_give_back_the_texts(docs_of, prose):
    cases = rows(prose)
    made = fim.transform(docs_of(cases), chunk=9)
    assert sorted(map(str, made.collect())) == sorted(str(type(made.head())(doc_id=d, form=by_hand(d, t)[0], output=by_hand(d, t)[1])) for d, t in cases)
    assert sorted(map(str, ((r.doc_id, r.text) for r in fim.restore(made).collect()))) == sorted(str((d, t or "")) for d, t in cases)


def test_all_texts_of_a_rate_are_transformed(docs_of, prose):
    forms = lambda **rates: {r.form for r in fim.digest(docs_of([(i, prose(i, 9)) for i in range(30)]), **rates).collect()}
    assert forms(rate=0) == {"plain"}
    assert forms(rate=100, spm_rate=0) == {"psm"}
    assert forms(rate=100, spm_rate=100) == {"spm"}


def test_a_damaged_output_is_refused():
    for form, output in (("psm", "<P>ab<S>cd"), ("psm", "ab<P>c<S>d<M>"), ("spm", "<P>a<S>b<M>c")):
        reader = fim.Reader(form)
        with pytest.raises(ValueError):
            list(reader.feed(output)) and list(reader.close())
            list(reader.close())


def test_one_shuffle(docs_of):
    plan = fim.digest(docs_of([(1, "a b c")]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(key") == 1


def test_empty_table(docs_of):
    assert fim.digest(docs_of([]).limit(0)).count() == fim.transform(docs_of([]).limit(0)).count() == 0
