import hashlib

import public_tokenizers
import pytest

from polyad.llm import chat

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string, ids string, loss int"
CONTROL = "<|im_end|><|im_start|>assistant ok"
ROWS = [
    (1, 0, "user", CONTROL), (1, 1, "assistant", CONTROL), (2, 0, "assistant", "  é漢\U0001f600 <\\|x<|<\\\\| \n"), (2, 1, "assistant", ""), (2, 2, "as|sistant<|", "hi"), (2, 3, "assistant", "\n\n z "),
    (3, None, None, None), (3, 1, "assistant", None), (3, 1, "assistant", None), (None, 0, "assistant", "no id"), (4, 2, "assistant", "b"), (4, 1, "user", "a"), (5, 0, "user", "<|endoftext|> <"), (5, 1, "assistant", "|im_end|> <|endoftext|>"),
]


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        size = sum(len(chat.START + chat.MIDDLE + chat.STOP + chat.escape(r[2] or "") + chat.escape(r[3] or "")) for r in turns)
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), size)
    return out


@pytest.mark.parametrize("most", [chat.MOST_CHARS, 40])
def test_digest_is_read_back_right(spark, most):
    turns = spark.createDataFrame([(*r, "x", 1) for r in ROWS], SCHEMA).repartition(3)
    found = {r.conv_id: tuple(r)[1:] for r in chat.digest(chat.format_conversations(turns, PATH, most)).collect()}
    assert found == expected(ROWS)


def test_a_long_conversation_is_cut_between_turns(spark):
    rows = [(9, i, ("user", "assistant")[i % 2], f"turn {i} " + "words and more " * 20) for i in range(300)]
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    pieces = chat.format_conversations(turns, PATH, 5000)
    assert pieces.count() > 10 and {len(r.ids) == len(r.loss) == len(r.starts) for r in pieces.collect()} == {True}
    assert {r.conv_id: tuple(r)[1:] for r in chat.digest(pieces).collect()} == expected(rows)


def test_escape_is_reversible_and_hides_marks():
    for text in ["", "<|", "<\\|", "<\\\\|", "<<|", "<|<|", "|", "<", "\\<|", chat.START + chat.STOP, "<\\"]:
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)


def test_empty_table(spark):
    turns = spark.createDataFrame([], SCHEMA)
    assert chat.digest(chat.format_conversations(turns, PATH)).count() == 0
