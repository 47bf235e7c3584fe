import hashlib

import pytest

from mdlake.llm import chat

MARKED = "\\### Assistant: </turn> ok"


@pytest.mark.parametrize("text", ["", MARKED, "a\nb", "\\h\\\\l", "### x: y </turn>\n### z: ", "\U0001f600 </turn>"])
def test_escapes_round_trip(text):
    made = chat.format_turns([("user", text), ("assistant", text), ("assi:st#ant\n", text)])
    assert chat.parse(made.text) == [("user", text), ("assistant", text), ("assi:st#ant\n", text)]
    assert [chat.unescape(made.text[a:b]) for a, b in made.loss] == [text]


def test_long_conversations_are_spanned_in_blocks():
    turns = [("user" if i % 2 == 0 else "assistant", f"t{i} {MARKED}") for i in range(3 * chat.STRIDE + 5)]
    made = chat.format_turns(turns)
    assert made.spans == chat._prefix_spans(turns, chat.render)


def test_rewriting_templates_are_found():
    def last_only(turns):
        return f"[{len(turns)} turns] " + "".join(t for _, t in turns[-1:])

    def numbered(turns):  # not local: each turn names its number from the start
        return "".join(f"{i} {r}: {t}\n" for i, (r, t) in enumerate(turns))

    turns = [("user", "x"), ("assistant", "y")] * 60
    assert chat.format_turns(turns, last_only).rewrites
    made = chat.format_turns(turns, numbered)
    assert not made.rewrites and made.spans == chat._prefix_spans(turns, numbered)


def test_rows_of_all_kinds(spark):
    rows = [
        (1, 2, "assistant", None, "x"),
        (1, 1, "user", "hi", "x"),
        (1, None, None, "first", "x"),
        (2, 1, "assistant", "same", "x"),
        (2, 1, "assistant", "same", "x"),
        (None, 1, "assistant", "z" * 200_000, "x"),
    ]
    table = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING, formatted STRING")
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(table)).collect()}
    assert got[1].n_turns == 3 and got[1].loss_chars == 0
    assert got[1].turns_sha256 == hashlib.sha256(b"\nfirst\nuser\nhi\nassistant\n\n").hexdigest()
    assert got[2].loss_sha256 == hashlib.sha256(b"samesame").hexdigest()
    assert got[None].loss_chars == 200_000
    assert chat.format_conversations(table.limit(0)).count() == 0
