"""Token counts by a compiled transducer.

The tokenizer's splitting pattern is a deterministic transducer over classes of
characters with five states; a transition that begins a word emits one mark. A
block of texts is cut into chunks, each chunk's map from entry state to exit
state is computed for all chunks at once, and the maps compose by a parallel
prefix scan, which gives every chunk its entry state and every character its
mark. Words then pass through a second transducer, compiled as it is needed, whose
transitions carry the change in the number of tokens that a further character
brings: the encoding of a prefix changes only within the longest suffix that some
token begins with, so the tokens that end inside this suffix are the state.

Both tables are bounded: the compiled part is dropped once it has grown to
``STATES`` transitions, and so is the memo of words.

Edge cases: NULL text counts as empty and has no tokens. The special strings are
one token each. Repeated rows are counted each. Columns beyond ``doc_id`` and
``text`` are not looked at.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from .common import blocks, map_batches, worker_memory

CHUNK = 256  # characters that step in turn; all chunks of a block step at once
WORDS = 400_000  # words that a worker remembers at most
STATES = 250_000  # compiled transitions at most
BLANK, LETTER, NUMBER, OTHER, SHORT, LONG = range(6)  # SHORT and LONG: an apostrophe that may begin a contraction of one or two letters
OUT, IN_LETTERS, IN_OTHERS, ONE_MORE, TWO_MORE = range(5)
# the next state for each state and class, and whether a word begins there
NEXT = np.array([[OUT, IN_LETTERS, OUT, IN_OTHERS, ONE_MORE, TWO_MORE]] * 2 + [[OUT, IN_LETTERS, OUT, IN_OTHERS, IN_OTHERS, IN_OTHERS], [OUT] * 6, [ONE_MORE] * 6], np.uint8)
BEGINS = np.array([[0, 1, 1, 1, 1, 1], [0, 0, 1, 1, 1, 1], [0, 1, 1, 0, 0, 0], [0] * 6, [0] * 6], bool)


def _classes() -> np.ndarray:
    """The class of every code point, apostrophes apart."""
    import regex

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((BLANK, r"\s"), (LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
        out[np.frombuffer("".join(regex.findall(pattern, every)).encode("utf-32-le"), np.uint32)] = kind
    return out


def scan(classes: np.ndarray) -> np.ndarray:
    """Where words begin, for a sequence of classes that starts outside a word."""
    n = len(classes)
    chunks = -(-n // CHUNK)
    steps = np.zeros((CHUNK, chunks), np.uint8)  # padded with blanks
    padded = np.zeros(chunks * CHUNK, np.uint8)
    padded[:n] = classes
    steps[:] = padded.reshape(chunks, CHUNK).T
    table = NEXT.ravel()
    maps = np.repeat(np.arange(5, dtype=np.uint8)[:, None], chunks, axis=1)
    for row in steps:
        maps = table[maps * np.uint8(6) + row]
    # inclusive scan by doubling: each map is composed with the one of so many chunks before
    reach, columns = 1, np.arange(chunks)
    while reach < chunks:
        maps[:, reach:] = maps[maps[:, :-reach], columns[reach:]]
        reach *= 2
    state = np.concatenate([[OUT], maps[OUT, :-1]]).astype(np.uint8)
    begins = np.zeros((CHUNK, chunks), bool)
    starts = BEGINS.ravel()
    for k, row in enumerate(steps):
        at = state * np.uint8(6) + row
        begins[k] = starts[at]
        state = table[at]
    return begins.T.ravel()[:n]


class Transducer:
    """Counts the tokens of a word, a symbol at a time. ``merges``: pairs of symbols in order of rank."""

    def __init__(self, vocabulary: set[str], merges: list[tuple[str, str]], ending: str):
        self.vocabulary, self.ending = vocabulary, ending
        self.ranks = {pair: i for i, pair in enumerate(merges)}
        self.symbols_of: dict[str, tuple[str, ...]] = {}
        for token in vocabulary:
            body = token.removesuffix(ending) if token != ending else token
            self.symbols_of[token] = (*body[:-1], body[-1] + ending) if token.endswith(ending) and token != ending else tuple(body)
        self.prefixes = {"".join(s[:k]) for s in self.symbols_of.values() for k in range(1, len(s))}
        self.forget()

    def forget(self) -> None:
        # a state: the suffix that a token may go on from, the last token before each of its places, and token counts there
        first = ("", (None,), (0,))
        self.states, self.numbers = [first], {first: 0}
        self.moves: dict[tuple[int, str], tuple[int, int]] = {}
        self.pairs: dict[tuple[str | None, str], bool] = {}

    def merged(self, symbols: list[str]) -> list[str]:
        """The encoding by its definition: the least rank first, the leftmost of equals."""
        symbols = list(symbols)
        while len(symbols) > 1:
            rank, at = min((self.ranks.get(pair, len(self.ranks)), i) for i, pair in enumerate(zip(symbols, symbols[1:])))
            if rank == len(self.ranks):
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def follows(self, before: str | None, token: str) -> bool:
        """Whether an encoding can have these tokens next to each other."""
        found = self.pairs.get((before, token))
        if found is None:
            tokens = [token] if before is None else [before, token]
            found = self.pairs[before, token] = self.merged([s for t in tokens for s in self.symbols_of[t]]) == tokens
        return found

    def move(self, state: int, symbol: str) -> tuple[int, int]:
        """The next state (-1 at a word's end) and the change in the number of tokens."""
        window, lasts, counts = self.states[state]
        for k in range(len(window) + 1):
            token = window[k:] + symbol
            if token in self.vocabulary and self.follows(None, token) and (lasts[k] is None or self.follows(lasts[k], token)):
                break
        else:
            raise ValueError(f"no token for {symbol!r}")
        change = counts[k] + 1
        if symbol.endswith(self.ending) and len(symbol) > 1:
            return -1, change
        longer = window + symbol
        lasts, counts = (*lasts, token), (*(c - change for c in counts), 0)
        cut = 0
        while cut < len(longer) and longer[cut:] not in self.prefixes:
            cut += 1
        new = (longer[cut:], lasts[cut:], counts[cut:])
        number = self.numbers.get(new)
        if number is None:
            number = self.numbers[new] = len(self.states)
            self.states.append(new)
        return number, change

    def count(self, symbols: str) -> int:
        """The number of tokens of a word."""
        if len(self.moves) > STATES or len(self.pairs) > 2 * STATES:
            self.forget()
        state = total = 0
        moves = self.moves
        for symbol in chain(symbols[:-1], (symbols[-1] + self.ending,)):
            found = moves.get((state, symbol))
            if found is None:
                found = moves[state, symbol] = self.move(state, symbol)
            state = found[0]
            total += found[1]
        return total


class Counter:
    """A tokenizer file, compiled. Its normaliser is the library's own."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as lines:
            plan = json.load(lines)
        model = plan["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.transducer = Transducer(set(model["vocab"]), merges, model["end_of_word_suffix"])
        self.normalize = Tokenizer.from_file(path).normalizer.normalize_str
        self.special = re.compile("(" + "|".join(re.escape(t["content"]) for t in plan["added_tokens"]) + ")")
        self.classes = _classes()
        self.symbols = _byte_symbols()
        self.words: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        """The numbers of tokens of whole texts."""
        parts, owners, extra = [], [], np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            for i, part in enumerate(self.special.split(text) if "<|" in text else (text,)):
                if i % 2:
                    extra[k] += 1
                elif part:
                    parts.append(part.lower() if part.isascii() else self.normalize(part))
                    owners.append(k)
        if not parts:
            return extra.tolist()
        whole = "\n".join(parts) + "\n"
        codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        classes = self.classes[codes]
        self._contractions(codes, classes)
        begins = np.flatnonzero(scan(classes))
        # a word ends where the next one begins, or at the blank before that
        blanks = np.flatnonzero(classes == BLANK)
        ends = np.minimum(np.append(begins[1:], len(codes)), blanks[np.minimum(np.searchsorted(blanks, begins), len(blanks) - 1)])
        words = [whole[i:j] for i, j in zip(begins.tolist(), ends.tolist(), strict=True)]
        if len(self.words) > WORDS:
            self.words.clear()
        memo = self.words
        for word in set(words) - memo.keys():
            memo[word] = self.transducer.count("".join(map(self.symbols.__getitem__, word.encode("utf-8", "replace"))))
        counts = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
        stops = np.cumsum([len(p) + 1 for p in parts])
        of = np.array(owners)[np.searchsorted(stops, begins, side="right")]
        return (extra + np.bincount(of, counts, len(texts)).astype(np.int64)).tolist()

    @staticmethod
    def _contractions(codes: np.ndarray, classes: np.ndarray) -> None:
        """Marks apostrophes that 's, 't, 'm, 'd or 're, 've, 'll may follow from."""
        at = np.flatnonzero(codes[:-2] == ord("'"))
        one, two = codes[at + 1], codes[at + 2]
        classes[at[np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
        pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        classes[at[pair]] = LONG


def _byte_symbols() -> list[str]:
    """The printable stand-ins of byte-level vocabularies: a byte's own character if it is visible, else one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(others)) for b in range(256)]


def count_tokens(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``; ``path``: a tokenizer file that every worker has."""

    def run(source: Iterator[tuple]) -> Iterator[list]:
        own = worker_memory(f"counter {path}", lambda: Counter(path))
        for held in blocks(source, 1):
            counts = own.count([r[1] or "" for r in held])
            yield [[r[0] for r in held], [len((r[1] or "").encode("utf-8", "surrogatepass")) for r in held], counts, [n > limit for n in counts]]

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
