"""Byte-level BPE by recursive queries, one DuckDB database per Python worker.

Encoding: a block's distinct words become rows (word, place, token), one per
byte. A recursive query joins neighbouring tokens with the merge table, finds
each word's least rank and contracts the pairs of that rank from the left, until
no word has a pair in the table. Decoding takes the ids of whole texts: rows of a place
and a token's bytes are aggregated in order of place, ``PIECE`` rows at a time. Blocks
bound what a database holds; Spark deals the texts out, and nothing is shuffled.

The merge table has every split of a token into two tokens, ranked by the whole
token, which is what a rank file means. A word that is itself a token stays whole.

Edge cases: NULL text counts as empty and has no tokens; characters that cannot
be encoded (lone surrogates) become U+FFFD. Repeated rows are encoded each. Columns
beyond ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import blocks, map_batches, worker_memory

MEMORY = "300MB"  # a database's working memory
MEMO = 350_000  # words that a worker remembers at most
SHORT = 48  # bytes of a word that contracts one pair a round
CHUNK = 200_000  # bytes of short words in one recursive query
PIECE = 250_000  # ids that one query decodes
STATES = 2_000_000  # rows that a recursive query over long words may pile up, if one round has no more

# k: round; w: word; p, e: first place of a token and of the next one, over all words, with a gap between words; t: token
STEP = """
WITH RECURSIVE step(k, w, p, e, t) AS (
    SELECT 0, w, p, p + 1, t FROM bytes_of_words
  UNION ALL
    SELECT s.k + 1, s.w, s.p, CASE WHEN s.p = best.p THEN best.e ELSE s.e END, CASE WHEN s.p = best.p THEN best.merged ELSE s.t END
    FROM step s
    JOIN (
        SELECT a.w, min(m.merged) AS merged,
               arg_min(a.p, m.merged::BIGINT << 40 | a.p) AS p, arg_min(b.p, m.merged::BIGINT << 40 | a.p) AS q, arg_min(b.e, m.merged::BIGINT << 40 | a.p) AS e
        FROM step a JOIN step b ON b.p = a.e JOIN merges m ON m.pair = a.t::BIGINT << 32 | b.t
        GROUP BY a.w
    ) best ON best.w = s.w
    WHERE s.p <> best.q
)
SELECT w, p, t FROM step SEMI JOIN (SELECT w, max(k) AS k FROM step GROUP BY w) USING (w, k) ORDER BY p
"""

# i: place within the word; of a run of overlapping places of one pair, every other is taken, from the left
ROUNDS = """
WITH RECURSIVE step(k, w, i, t) AS (
    SELECT 0, w, i, t FROM state
  UNION ALL
    SELECT k + 1, w, i, CASE WHEN take THEN merged ELSE t END
    FROM (
        SELECT *, coalesce(lag(take) OVER (PARTITION BY w ORDER BY i), false) AS taken
        FROM (
            SELECT *, hit AND (row_number() OVER (PARTITION BY w, hit, island ORDER BY n)) % 2 = 1 AS take
            FROM (
                SELECT *, n - row_number() OVER (PARTITION BY w, hit ORDER BY n) AS island
                FROM (
                    SELECT *, coalesce(merged = least, false) AS hit
                    FROM (
                        SELECT p.*, m.merged, min(m.merged) OVER (PARTITION BY p.w) AS least
                        FROM (SELECT *, lead(t) OVER word AS r, row_number() OVER word AS n FROM step WHERE k < $rounds WINDOW word AS (PARTITION BY w ORDER BY i)) p
                        LEFT JOIN merges m ON m.pair = p.t::BIGINT << 32 | p.r
                    ) WHERE least IS NOT NULL
                )
            )
        )
    ) WHERE NOT taken
)
SELECT w, i, t, k FROM step SEMI JOIN (SELECT w, max(k) AS k FROM step GROUP BY w) USING (w, k) ORDER BY w, i
"""

DECODE = "SELECT string_agg(h, '' ORDER BY i) FROM piece"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def encoded(text: str) -> bytes:
    """UTF-8, with U+FFFD for a lone surrogate."""
    try:
        return text.encode()
    except UnicodeEncodeError:
        return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace").encode()


class Coder:
    """A rank file in a DuckDB database of its own, and a bounded memo of the words that it has encoded."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        self.ranks = load_ranks(path)
        self.words = regex.compile(pattern).findall
        splits = [(self.ranks[a], self.ranks[b], n) for token, n in self.ranks.items() for i in range(1, len(token)) if (a := token[:i]) in self.ranks and (b := token[i:]) in self.ranks]
        left, right, whole = np.array(splits, np.int64).T
        merges = pa.table({"pair": left << 32 | right, "merged": whole.astype(np.int32)})  # noqa: F841
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        self.db.execute("CREATE TABLE merges AS FROM merges")
        tokens = {n: t for t, n in self.ranks.items()}
        whole = range(max(tokens) + 1)
        self.hex = pa.array([tokens.get(n, b"").hex() for n in whole])  # of every id
        self.sizes = np.array([len(tokens.get(n, b"")) for n in whole], np.int64)
        self.decimal = pa.array([str(n) for n in whole])
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.forget()

    def forget(self) -> None:
        """Empty the memo: ``memo`` has each word's place in ``ends``, where its ids end in ``ids``."""
        self.memo: dict[str, int] = {}
        self.ids, self.ends = array("i"), array("q", [0])

    def contract(self, words: list[bytes]) -> list[np.ndarray]:
        """Token ids of short words, none of them empty."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        w = np.repeat(np.arange(len(words)), lengths)
        self.db.register("bytes_of_words", pa.table({"w": w.astype(np.int32), "p": np.arange(len(w)) + w, "t": self.single[np.frombuffer(b"".join(words), np.uint8)]}))
        found = self.db.execute(STEP).fetchnumpy()
        self.db.unregister("bytes_of_words")
        ends = np.searchsorted(found["w"], np.arange(1, len(words) + 1)).tolist()
        return [found["t"][i:j] for i, j in zip([0, *ends], ends)]

    def contract_long(self, word: bytes) -> np.ndarray:
        """Token ids of one long word; a query does as many rounds as its rows allow, and the next goes on from there."""
        ids = self.single[np.frombuffer(word, np.uint8)]
        while True:
            self.db.register("state", pa.table({"w": np.zeros(len(ids), np.int32), "i": np.arange(len(ids)), "t": ids}))
            rounds = max(1, STATES // len(ids))
            found = self.db.execute(ROUNDS, {"rounds": rounds}).fetchnumpy()
            self.db.unregister("state")
            ids = found["t"].astype(np.int32)
            if found["k"][0] < rounds:
                return ids

    def learn(self, words: set[str]) -> None:
        """Enter words in the memo."""
        done: list[tuple[str, np.ndarray]] = []
        held: dict[str, bytes] = {}
        size = 0

        def contract() -> None:
            if held:
                done.extend(zip(held, self.contract(list(held.values())), strict=True))
                held.clear()

        for word in words:
            data = encoded(word)
            if (token := self.ranks.get(data)) is not None:
                done.append((word, np.array([token], np.int32)))
            elif len(data) > SHORT:
                done.append((word, self.contract_long(data)))
            else:
                held[word] = data
                size += len(data)
                if size > CHUNK:
                    contract()
                    size = 0
        contract()
        for word, ids in done:
            self.memo[word] = len(self.ends) - 1
            self.ids.frombytes(ids.astype(np.int32).tobytes())
            self.ends.append(len(self.ids))

    def places(self, texts: list[str]) -> list[list[int]]:
        """For every text, its words' places in the memo."""
        split = [self.words(text) for text in texts]
        if len(self.memo) > MEMO:
            self.forget()
        self.learn({word for words in split for word in words} - self.memo.keys())
        return [list(map(self.memo.__getitem__, words)) for words in split]

    def gather(self, places: list[list[int]]) -> list[np.ndarray]:
        """For every text, the ids of its words in order."""
        flat, ends = np.array(self.ids, np.int32), np.array(self.ends, np.int64)
        at = np.fromiter(chain.from_iterable(places), np.int64, sum(map(len, places)))
        sizes = ends[at + 1] - ends[at]
        stops = sizes.cumsum()
        ids = flat[np.repeat(ends[at] - stops + sizes, sizes) + np.arange(sizes.sum())]
        words = np.cumsum([len(p) for p in places])
        return np.split(ids, np.concatenate([[0], stops])[words[:-1]]) if len(places) else []

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.gather(self.places(texts))

    def decode(self, sequences: list[np.ndarray]) -> list[bytes]:
        """The bytes of id sequences, put one after the other: an ordered aggregation for each piece, cut where each sequence's bytes end."""
        flat = np.concatenate([np.zeros(0, np.int32), *sequences])
        parts = []
        for start in range(0, len(flat), PIECE):
            ids = flat[start : start + PIECE]
            self.db.register("piece", pa.table({"i": np.arange(len(ids)), "h": self.hex.take(pa.array(ids))}))
            parts.append(bytes.fromhex(self.db.execute(DECODE).fetchall()[0][0]))
            self.db.unregister("piece")
        whole = b"".join(parts)
        ends = np.concatenate([[0], np.cumsum(self.sizes[flat])])[np.cumsum([0, *map(len, sequences)])].tolist()
        return [whole[i:j] for i, j in zip(ends, ends[1:])]

    def listed(self, sequences: list[np.ndarray]) -> Iterator[str]:
        """The SHA-256 of every sequence's decimal ids, joined by blanks; long ones are joined a piece at a time."""
        for start in range(0, len(sequences), 256):
            part = sequences[start : start + 256]
            cut = [x[i : i + PIECE] for x in part for i in range(0, max(len(x), 1), PIECE)]
            text = iter(self._joined(cut))
            for x in part:
                digest = hashlib.sha256(next(text))
                for _ in range(PIECE, len(x), PIECE):
                    digest.update(b" ")
                    digest.update(next(text))
                yield digest.hexdigest()

    def _joined(self, sequences: list[np.ndarray]) -> Iterator[pa.Buffer]:
        held, size = [], 0
        for x in [*sequences, None]:
            if x is None or size + len(x) > 4 * PIECE:
                flat = np.concatenate([np.zeros(0, np.int32), *held])
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, held)]), pa.int32()), self.decimal.take(pa.array(flat)))
                yield from (y.as_buffer() for y in pc.binary_join(lists, " "))
                held, size = [], 0
            if x is not None:
                held.append(x)
                size += len(x)


def coder(path: str, pattern: str) -> Coder:
    return worker_memory(f"bpe {path} {pattern}", lambda: Coder(path, pattern))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` for every row of ``docs``; ``path``: a rank file that every worker has."""

    def run(source: Iterator[tuple]) -> Iterator[list]:
        own = coder(path, pattern)
        for held in blocks(source, 1):
            yield [[r[0] for r in held], own.encode([r[1] or "" for r in held])]

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, data`` (bytes) for every row of ``encoded`` (``doc_id``, ``ids``)."""

    def run(source: Iterator[tuple]) -> Iterator[list]:
        own = coder(path, pattern)
        for held in blocks(source, 1, 250_000):
            yield [[r[0] for r in held], own.decode([np.array(r[1] or [], np.int32) for r in held])]

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id long, data binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encodes every text and decodes its ids: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    A word is encoded once while it is remembered; what is decoded are the ids of the whole texts.
    """

    def run(source: Iterator[tuple]) -> Iterator[list]:
        own = coder(path, pattern)
        for held in blocks(source, 1, 1_000_000):
            ids = own.encode([r[1] or "" for r in held])
            yield [
                [r[0] for r in held],
                [len(x) for x in ids],
                list(own.listed(ids)),
                [hashlib.sha256(x).hexdigest() for x in own.decode(ids)],
            ]

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
