import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from polyad.llm import tokencount as tc

from .conftest import ODD

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def counter():
    return tc.Counter(PATH)


def test_counts_match_the_library(docs_of):
    rng = random.Random(4)
    texts = ["".join(rng.choice("'stmdrevl ab!=\n\tiné\U0001f600漢ßÇΣx01") for _ in range(rng.randint(0, 120))) for _ in range(400)]
    texts += [*ODD, "<|endoftext|>", "a<|startoftext|> b<|endoftext|><|endoftext|>'s", "İΣΑΣ ΟΔΟΣ", "x'", "'r", "'re", "''s", "!'ll", "'street don't", "é 한가"]
    library = Tokenizer.from_file(PATH)
    rows = list(enumerate(texts))
    found = {r.doc_id: r for r in tc.count_tokens(docs_of(rows), PATH, limit=50).collect()}
    for i, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (found[i].n_tokens, found[i].n_bytes, found[i].over_limit) == (n, len((text or "").encode()), n > 50)


def test_chunk_maps_compose_like_a_single_pass():
    rng = np.random.default_rng(1)
    for n in (0, 1, 255, 256, 257, 5000):
        classes = rng.integers(0, 6, n).astype(np.uint8)
        state, expected = tc.OUT, []
        for c in classes:
            expected.append(tc.BEGINS[state, c])
            state = tc.NEXT[state, c]
        assert tc.scan(classes).tolist() == expected


def test_compiled_part_is_bounded(counter, monkeypatch):
    words = [w for w in "unbelievable antidisestablishment counterrevolutionary zyxwvuts qqqqqq".split()]
    symbols = [counter.symbols]
    before = [counter.transducer.count("".join(symbols[0][b] for b in w.encode())) for w in words]
    monkeypatch.setattr(tc, "STATES", 3)
    assert [counter.transducer.count("".join(symbols[0][b] for b in w.encode())) for w in words] == before
    whole = [len(counter.transducer.merged([*(symbols[0][b] for b in w.encode()[:-1]), symbols[0][w.encode()[-1]] + "</w>"])) for w in words]
    assert before == whole


def test_repeated_rows_null_ids_and_empty_tables(docs_of):
    found = tc.count_tokens(docs_of([(1, "same"), (1, "same"), (None, None)]), PATH).collect()
    assert sorted(r.n_tokens for r in found) == [0, 1, 1]
    assert tc.count_tokens(docs_of([]).limit(0), PATH).count() == 0
