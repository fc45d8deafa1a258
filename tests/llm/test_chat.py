import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from cratework.llm import chat

EVENT = "conv_id long, turn long, message long, seq int, kind string, role string, text string"


@given(st.text(), st.text())
def test_escapes_are_reversible(role, text):
    assert chat.unescape(chat.escape(text)) == text and chat.unescape(chat.escape(role, True)) == role
    turn = f"{chat.OPEN}{chat.escape(role, True)}: {chat.escape(text)}{chat.CLOSE}"
    assert chat.parse(turn * 2) == [(role, text)] * 2
    assert "###" not in chat.escape(text) and "</turn>" not in chat.escape(text)


def test_foreign_text_is_refused():
    with pytest.raises(ValueError):
        chat.parse("### user: hi</turn>\nrest")


def test_fold(session):
    log = [
        (1, 0, 0, 0, "open", "user", None),
        (1, 0, 0, 1, "delta", None, "dra"),
        (1, 0, 0, 2, "edit", None, "whole"),
        (1, 0, 0, 3, "delta", None, "!"),
        (1, 1, 1, 0, "open", "assistant", None),
        (1, 1, 1, 1, "delta", None, "bad"),
        (1, 1, 1, 2, "regenerate", None, None),
        (1, 1, 1, 4, "delta", None, "od"),
        (1, 1, 1, 3, "delta", None, "go"),
        (1, 2, 2, 0, "open", "user", None),
        (1, 2, 2, 1, "delete", None, None),
        (2, 0, 3, 0, "delta", None, None),
    ]
    df = session.createDataFrame(log, EVENT).repartition(4)
    got = sorted((r.conv_id, r.turn, r.role, r.text) for r in chat.fold(df).collect())
    assert got == [(1, 0, "user", "whole!"), (1, 1, "assistant", "good"), (2, 0, "", "")]
    assert chat.fold(df.limit(0)).count() == 0


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_read_back_equals_input(session):
    marks = "\\### Assistant: </turn> ok"
    rows = [
        (1, 1, "assistant", "tail 😀"),
        (1, 0, "user", marks),
        (1, 2, "assistant", marks),
        (2, 0, "system", None),
        (2, 1, None, "no role"),
        (3, 5, "assistant", ""),
        (4, 0, "user", "same"),
        (4, 0, "user", "same"),
        (None, None, "assistant", "x" * 70_000),
    ]
    df = session.createDataFrame([(*r, 1, "m") for r in rows], "conv_id long, turn long, role string, text string, seq int, message string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(chat.log_of(df.repartition(3)))).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        learned = "".join(t for _, role, t in turns if role == "assistant")
        found = got[conv]
        assert found.n_turns == len(turns)
        assert found.turns_sha256 == digest("".join(f"{role}\n{t}\n" for _, role, t in turns))
        assert (found.loss_chars, found.loss_sha256) == (len(learned), digest(learned))


def test_many_turns_in_one_conversation(session):
    df = session.range(3000).selectExpr("1L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('t', id) as text")
    found = chat.read_back(chat.format_chats(chat.log_of(df.repartition(5)))).first()
    want = "".join(f"{'assistant' if k % 2 else 'user'}\nt{k}\n" for k in range(3000))
    assert found.n_turns == 3000 and found.turns_sha256 == digest(want)
