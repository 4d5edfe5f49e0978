"""Chat formatting with an offset-aligned loss mask.

A turn is rendered as <|im_start|>role<|im_sep|>text<|im_end|>. The marks are
special tokens, so no token reaches from a mark into a text, and inside roles and
texts "<|" cannot occur: each "<", any backslashes and "|" get one more backslash,
which reading back takes away. Whole conversations are rendered and encoded
with offsets; the assistant's character spans and the tokens' spans, both
sorted, are intersected by binary search, and the tokens found carry the loss.

A conversation longer than ``most_chars`` goes on in further pieces, cut between
turns, where the marks keep encodings apart; so a task holds one piece at a time,
however long a conversation is. Turns meet by one shuffle on the conversation;
a conversation's pieces stay in one task, as its digest needs them in order.

Edge cases: NULL roles and texts count as empty. Turns are taken in the order of
turn, role and text, NULL first, and repeated rows are turns each. Turns without a
conv_id are one conversation. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, worker_memory

START, MIDDLE, STOP = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LEARNED = "assistant"
MOST_CHARS = 1_000_000
_TURN = re.compile(r"<\|im_start\|>(.*?)<\|im_sep\|>(.*?)<\|im_end\|>", re.DOTALL)


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text, and the spans in it that the loss is taken on."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head = f"{START}{escape(role)}{MIDDLE}"
        body = escape(text)
        if role == LEARNED:
            spans.append((at + len(head), at + len(head) + len(body)))
        out.append(f"{head}{body}{STOP}")
        at += len(out[-1])
    return "".join(out), spans


def loss_mask(starts: np.ndarray, stops: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens overlap a span; tokens and spans are in order."""
    wanted = np.array(spans, np.int64).reshape(-1, 2)
    first = np.searchsorted(stops, wanted[:, 0], side="right")
    last = np.searchsorted(starts, wanted[:, 1], side="left")
    change = np.zeros(len(starts) + 1, np.int64)
    full = last > first
    np.add.at(change, first[full], 1)
    np.add.at(change, last[full], -1)
    return change.cumsum()[:-1] > 0


def masked_text(formatted: str, starts: list[int], stops: list[int], loss: list[bool]) -> str:
    """The text under the mask, unescaped; tokens that share a character count it once."""
    out, at, begin = [], 0, None
    for start, stop, on in zip(starts, stops, loss, strict=True):
        if not on:
            continue
        if begin is None or start > at:
            if begin is not None:
                out.append(unescape(formatted[begin:at]))
            begin, at = start, stop
        at = max(at, stop)
    if begin is not None:
        out.append(unescape(formatted[begin:at]))
    return "".join(out)


def _tokenizer(path: str):
    def make():
        from tokenizers import AddedToken, Tokenizer

        made = Tokenizer.from_file(path)
        made.add_special_tokens([AddedToken(mark, special=True, normalized=False) for mark in (START, MIDDLE, STOP)])
        return made

    return worker_memory(f"chat {path}", make)


def format_conversations(turns: DataFrame, path: str, most_chars: int = MOST_CHARS) -> DataFrame:
    """``conv_id, piece, formatted, ids, starts, stops, loss``, in order of pieces within a partition."""
    schema = "conv_id long, piece int, formatted string, ids array<int>, starts array<int>, stops array<int>, loss array<boolean>"
    count = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(source: Iterator[tuple]) -> Iterator[list]:
        own = _tokenizer(path)

        def done(pieces: list[tuple[int, int, list]]) -> list[list]:
            texts, spans = zip(*(render(held) for _, _, held in pieces), strict=True)
            out = []
            for (conv, number, _), text, wanted, found in zip(pieces, texts, spans, own.encode_batch(list(texts), add_special_tokens=False), strict=True):
                starts, stops = np.array(found.offsets, np.int32).reshape(-1, 2).T
                out.append((conv, number, text, found.ids, starts, stops, loss_mask(starts, stops, wanted)))
            return [list(c) for c in zip(*out, strict=True)]

        ready, turns, size, conv, number, total = [], [], 0, None, 0, 0
        for conv_id, role, text in source:
            if turns and (conv_id != conv or size >= most_chars):
                ready.append((conv, number, turns))
                number = number + 1 if conv_id == conv else 0
                total += size
                turns, size = [], 0
                if total >= most_chars:
                    yield done(ready)
                    ready, total = [], 0
            conv = conv_id
            turns.append((role or "", text or ""))
            size += len(role or "") + len(text or "") + len(START + MIDDLE + STOP)
        if turns:
            ready.append((conv, number, turns))
        if ready:
            yield done(ready)

    order = ["conv_id", "turn", "role", "text"]
    together = turns.select(*order).repartition(count, "conv_id").sortWithinPartitions(*(F.asc_nulls_first(c) for c in order))
    return map_batches(together.select("conv_id", "role", "text"), run, schema)


def digest(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from ``format_conversations``: what its turns and the text under its mask are."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(source: Iterator[tuple]) -> Iterator[list]:
        rows, now = [], None

        def close() -> None:
            if now is not None:
                rows.append((now["conv"], now["turns"], now["all"].hexdigest(), now["chars"], now["loss"].hexdigest(), now["size"]))

        for conv_id, piece, text, starts, stops, loss in source:
            if now is None or conv_id != now["conv"] or piece == 0:
                close()
                now = {"conv": conv_id, "turns": 0, "all": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "size": 0}
            for role, body in _TURN.findall(text):
                now["turns"] += 1
                now["all"].update(f"{unescape(role)}\n{unescape(body)}\n".encode("utf-8", "surrogatepass"))
            learned = masked_text(text, starts, stops, loss)
            now["loss"].update(learned.encode("utf-8", "surrogatepass"))
            now["chars"] += len(learned)
            now["size"] += len(text)
            if len(rows) >= 1000:
                yield [list(c) for c in zip(*rows, strict=True)]
                rows.clear()
        close()
        if rows:
            yield [list(c) for c in zip(*rows, strict=True)]

    return map_batches(formatted.select("conv_id", "piece", "formatted", "starts", "stops", "loss"), run, schema)
