"""Words of lower-cased text, as numbers and hashes, a block of texts at a time."""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END = ""  # the end of a text as a token; no word is empty


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    with np.errstate(over="ignore"):
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return x ^ x >> np.uint64(31)


class Tokens:
    """The tokens of a block of texts, by number; the last number is the end."""

    def __init__(self, texts: pa.Array):
        split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
        flat, parents = pc.list_flatten(split), pc.list_parent_indices(split)
        full = pc.greater(pc.binary_length(flat), 0)
        coded = flat.filter(full).dictionary_encode()
        self.words = coded.dictionary
        self.end = len(self.words)
        at = parents.filter(full).to_numpy(zero_copy_only=False).astype(np.int64)
        self.lengths = np.bincount(at, minlength=len(texts)).astype(np.int64) + 1  # with the end
        self.doc = np.repeat(np.arange(len(texts)), self.lengths)
        self.codes = np.full(len(self.doc), self.end, np.int64)
        self.codes[np.arange(len(at)) + at] = coded.indices.to_numpy(zero_copy_only=False)
        self.before = np.concatenate([[self.end], self.codes[:-1]])

    @cached_property
    def hashes(self) -> np.ndarray:
        """Of every token's word; cut from the buffer, which takes a fraction of the time of making a string of each word."""
        import xxhash

        _, offsets, data = self.words.buffers()
        ends = np.frombuffer(offsets, np.int32, self.end + 1, 4 * self.words.offset).tolist() if self.end else [0]
        whole = data.to_pybytes() if data is not None else b""
        cut = map(whole.__getitem__, map(slice, [*ends[:-1], 0], [*ends[1:], 0]))
        return np.fromiter(map(xxhash.xxh64_intdigest, cut), np.uint64, self.end + 1)

    def pairs(self, at: slice | np.ndarray = slice(None), inverse: bool = False) -> tuple:
        """Distinct (context, word) numbers of the tokens ``at`` these places, and their counts or every such token's place among them."""
        found, other = np.unique(self.before[at] * (self.end + 1) + self.codes[at], **{"return_inverse" if inverse else "return_counts": True})
        return found // (self.end + 1), found % (self.end + 1), other

    def sequence(self) -> tuple[np.ndarray, np.ndarray]:
        """The words' hashes without the ends, and each text's number of words."""
        return self.hashes[self.codes[self.codes != self.end]], self.lengths - 1
