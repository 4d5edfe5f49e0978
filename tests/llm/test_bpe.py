import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from polyad.llm import bpe

from .conftest import ODD

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


def junk(n):
    rng = random.Random(5)
    return ["".join(rng.choice("ab =-*#th e\n\tiné\U0001f600漢ßÇ'sx01") for _ in range(rng.randint(0, 200))) for _ in range(n)]


def test_ids_and_bytes_match_the_library(docs_of, library):
    texts = [*ODD, *junk(300), "=" * 3000, "a" * 700, "ab" * 900, " " * 500 + "x", "<|endoftext|>"]
    docs = docs_of(enumerate(texts))
    ids = {r.doc_id: r.ids for r in bpe.encode(docs, PATH, PATTERN).collect()}
    assert all(ids[i] == library.encode_ordinary(t or "") for i, t in enumerate(texts))
    data = {r.doc_id: bytes(r.data) for r in bpe.decode(bpe.encode(docs, PATH, PATTERN), PATH, PATTERN).collect()}
    assert all(data[i] == (t or "").encode() for i, t in enumerate(texts))


def test_overlapping_places_and_several_queries(monkeypatch, library):
    monkeypatch.setattr(bpe, "STATES", 400)
    coder = bpe.Coder(PATH, PATTERN)
    for word in (b"a" * 77, b"=" * 200, b"abab" * 30, b"xyzzy" * 25):
        assert coder.contract_long(word).tolist() == library.encode_ordinary(word.decode())


def test_memo_starts_anew(monkeypatch, library):
    monkeypatch.setattr(bpe, "MEMO", 5)
    coder = bpe.Coder(PATH, PATTERN)
    for text in ["one two three four five six seven", "one more", "", "seven six"]:
        assert coder.encode([text])[0].tolist() == library.encode_ordinary(text)


def test_repeated_rows_null_ids_and_empty_tables(docs_of):
    docs = docs_of([(1, "same"), (1, "same"), (None, None)])
    found = sorted(bpe.round_trip(docs, PATH, PATTERN).collect(), key=str)
    assert len(found) == 3 and [r.n_tokens for r in found if r.doc_id is None] == [0]
    assert bpe.round_trip(docs.limit(0), PATH, PATTERN).count() == 0


def test_a_wrong_id_changes_the_decoded_digest(docs_of, monkeypatch):
    path, texts = public_tokenizers.path("byte_bpe_50k.tiktoken"), [(1, "the river and the stone"), (2, "other words here")]
    right = {r.doc_id: r for r in bpe.round_trip(docs_of(texts), path, public_tokenizers.PATTERN).collect()}
    gather = bpe.Coder.gather

    def wrong(self, places):
        ids = gather(self, places)
        return [np.where(np.arange(len(x)) == 2, x + 1, x) if len(x) == 5 else x for x in ids]

    monkeypatch.setattr(bpe.Coder, "gather", wrong)
    found = {r.doc_id: r for r in bpe.round_trip(docs_of(texts), path, f"(?:{public_tokenizers.PATTERN})").collect()}
    assert found[1].decoded_sha256 != right[1].decoded_sha256 and found[1].ids_sha256 != right[1].ids_sha256
    assert found[2] == right[2]


def test_pieces_do_not_change_the_bytes(monkeypatch):
    own = bpe.Coder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = ["", "a", "Ünï çødé 漢字 \U0001f600 ok" * 30, "", "word " * 50]
    monkeypatch.setattr(bpe, "PIECE", 7)
    assert own.decode(own.encode(texts)) == [t.encode() for t in texts]
    assert list(own.listed(own.encode(texts))) == [hashlib.sha256(" ".join(map(str, x.tolist())).encode()).hexdigest() for x in own.encode(texts)]
    assert own.decode([]) == [] and own.encode([]) == []
