"""Fill-in-middle transformation by secondary sort.

Every text is cut into pieces of at most ``CHUNK`` code points, keyed by document and by
their position in the output. One shuffle brings a document's pieces together, sorted
within partitions, so a document streams through its task piece by piece: its digest grows
with them and no whole text is put together. For restoration the output is read as a
stream, whatever its cuts: the marks tell the sections apart, the pieces get their
position in the text, and are sorted by that within the same partitions.

A text has the form ``plain`` (unchanged) if it is empty, contains a mark or is drawn to
stay so; else ``psm``: prefix, suffix, middle, or ``spm``: suffix, prefix, middle, each
after its mark. Draws and cuts come from the SHA-256 of a seed and the doc_id. As no text
with a mark is transformed and a mark has its ``<`` in the first place only, none can
arise where a section and a mark meet, so the output and the form give back the text.

Edge cases: NULL text counts as empty. A NULL doc_id is hashed as the empty text. Rows
that repeat are transformed each: a row, not a doc_id, is the key. A text of any length is
one key, as its digest needs its pieces in order; only a batch of pieces is held. An
empty table gives an empty one. Columns beyond ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FORMS = {"plain": (), "psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1))}  # marks in order of output; place of their sections in the text
CHUNK = 1 << 14  # code points of a piece
SEED = 1
RATE, SPM_RATE = 90, 20  # of 100 texts, and of 100 transformed ones
_ROWS, _CHARS = 2000, 2_000_000  # of a batch
_END = 3  # after all sections


def plan(doc_id: int | None, text: str, rate: int = RATE, spm_rate: int = SPM_RATE, seed: int = SEED) -> tuple[str, int | None, int | None]:
    """Form, length of the prefix and length of the middle."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    draws = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or draws[2] % 100 >= rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return "plain", None, None
    low, high = sorted(h % (len(text) + 1) for h in draws[:2])
    return "spm" if draws[3] % 100 < spm_rate else "psm", low, high - low


def pieces(docs: DataFrame, rate: int = RATE, spm_rate: int = SPM_RATE, seed: int = SEED, chunk: int = CHUNK) -> DataFrame:
    """``key, at, piece, doc_id, n, form, prefix_chars, middle_chars``: the outputs' pieces; ``at`` counts the code points before one."""

    def cut(source: Iterator[tuple]) -> Iterator[list]:
        held, size = [], 0
        for key, doc_id, text in source:
            text = text or ""
            form, prefix, middle = plan(doc_id, text, rate, spm_rate, seed)
            cuts = [0, len(text)] if form == "plain" else [0, prefix, prefix + middle, len(text)]
            sections = [(mark, cuts[place], cuts[place + 1]) for mark, place in FORMS[form]] or [("", 0, len(text))]
            row, at = (doc_id, len(text), form, prefix, middle), 0
            for mark, low, high in sections:
                if mark or not text:
                    held.append((key, at, mark, *row))
                    at += len(mark)
                for start in range(low, high, chunk):
                    held.append((key, at, text[start : min(start + chunk, high)], *row))
                    size += len(held[-1][2])
                    at += len(held[-1][2])
                    if len(held) >= _ROWS or size >= _CHARS:
                        yield [list(c) for c in zip(*held, strict=True)]
                        held, size = [], 0
        if held:
            yield [list(c) for c in zip(*held, strict=True)]

    keyed = docs.select(F.monotonically_increasing_id().alias("key"), "doc_id", "text")
    return map_batches(keyed, cut, "key long, at long, piece string, doc_id long, n long, form string, prefix_chars long, middle_chars long")


def _sorted(cut: DataFrame) -> DataFrame:
    return cut.repartition("key").sortWithinPartitions("key", "at")


class Reader:
    """Reads an output as a stream: (section's place in the text, code points before in the section, piece)."""

    def __init__(self, form: str, chunk: int = CHUNK):
        self.marks, self.chunk = FORMS[form], chunk
        self.next, self.place, self.at = 0, None if self.marks else 0, 0
        self.open, self.held, self.size = "", [], 0  # not searched to the end yet; read, but not handed on

    def _keep(self, text: str) -> Iterator[tuple[int, int, str]]:
        if text:
            if self.place is None:
                raise ValueError("an output begins with no mark")
            self.held.append(text)
            self.size += len(text)
            if self.size >= self.chunk:
                yield from self._flush()

    def _flush(self) -> Iterator[tuple[int, int, str]]:
        if self.size:
            yield self.place, self.at, "".join(self.held)
            self.at += self.size
            self.held, self.size = [], 0

    def feed(self, piece: str) -> Iterator[tuple[int, int, str]]:
        self.open += piece
        while self.next < len(self.marks):
            mark, place = self.marks[self.next]
            found = self.open.find(mark)
            if found < 0:
                sure = max(len(self.open) - len(mark) + 1, 0)
                yield from self._keep(self.open[:sure])
                self.open = self.open[sure:]
                return
            yield from self._keep(self.open[:found])
            yield from self._flush()
            self.open = self.open[found + len(mark) :]
            self.next, self.place, self.at = self.next + 1, place, 0
        yield from self._keep(self.open)
        self.open = ""

    def close(self) -> Iterator[tuple[int, int, str]]:
        if self.next < len(self.marks):
            raise ValueError("an output lacks a mark of its form")
        yield from self._flush()


def _runs(source: Iterator[tuple]) -> Iterator[tuple[tuple, bool]]:
    """Rows of (key, ...), and whether one is its key's last."""
    before = None
    for row in source:
        if before is not None:
            yield before, before[0] != row[0]
        before = row
    if before is not None:
        yield before, True


def _read_back(cut: DataFrame, chunk: int) -> DataFrame:
    """(key, place, at, piece, doc_id, n, form, prefix_chars, middle_chars, output_sha256): the texts' pieces, read from the outputs; and at a key's end its row."""

    def run(source: Iterator[tuple]) -> Iterator[list]:
        held, size, reader, digest = [], 0, None, None
        none = (None,) * 6
        for (key, _, piece, *row), last in _runs(source):
            if reader is None:
                reader, digest = Reader(row[2], chunk), hashlib.sha256()
            digest.update(piece.encode("utf-8", "surrogatepass"))
            found = list(reader.feed(piece))
            if last:
                found += reader.close()
            size += sum(len(x[2]) for x in found)
            held += [(key, *x, *none) for x in found]
            if last:
                held.append((key, _END, 0, "", *row, digest.hexdigest()))
                reader = None
            if len(held) >= _ROWS or size >= _CHARS:
                yield [list(c) for c in zip(*held, strict=True)]
                held, size = [], 0
        if held:
            yield [list(c) for c in zip(*held, strict=True)]

    return map_batches(cut, run, "key long, place int, at long, piece string, doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string")


def digest(docs: DataFrame, rate: int = RATE, spm_rate: int = SPM_RATE, seed: int = SEED, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` for every row of ``docs``."""
    back = _read_back(_sorted(pieces(docs, rate, spm_rate, seed, chunk)), chunk).sortWithinPartitions("key", "place", "at")

    def run(source: Iterator[tuple]) -> Iterator[list]:
        held, restored = [], hashlib.sha256()
        for _, place, _, piece, *row in source:
            if place < _END:
                restored.update(piece.encode("utf-8", "surrogatepass"))
                continue
            held.append((*row, restored.hexdigest()))
            restored = hashlib.sha256()
            if len(held) >= _ROWS:
                yield [list(c) for c in zip(*held, strict=True)]
                held = []
        if held:
            yield [list(c) for c in zip(*held, strict=True)]

    return map_batches(back, run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string")


def transform(docs: DataFrame, rate: int = RATE, spm_rate: int = SPM_RATE, seed: int = SEED, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, form, output`` for every row of ``docs``; a task holds one output at a time."""

    def run(source: Iterator[tuple]) -> Iterator[list]:
        parts = []
        for (_, _, piece, doc_id, _, form, _, _), last in _runs(source):
            parts.append(piece)
            if last:
                yield [[doc_id], [form], ["".join(parts)]]
                parts = []

    return map_batches(_sorted(pieces(docs, rate, spm_rate, seed, chunk)), run, "doc_id long, form string, output string")


def restore(outputs: DataFrame) -> DataFrame:
    """``doc_id, text`` for every row of ``outputs`` (``doc_id, form, output``)."""

    def run(source: Iterator[tuple]) -> Iterator[list]:
        for doc_id, form, output in source:
            reader = Reader(form, len(output) + 1)
            found = [*reader.feed(output), *reader.close()]
            yield [[doc_id], ["".join(x[2] for x in sorted(found))]]

    return map_batches(outputs.select("doc_id", "form", "output"), run, "doc_id long, text string")
