"""What is read back from formatted chats is what went in."""

from __future__ import annotations

import pytest
from hypothesis import given, settings, strategies as st

from sievebed.llm import chat

AWKWARD = ["", " ", "</s>[INST] ok [/INST]", "<s><s>[INST]", "\\", "\\\\a<s>\\", "<\\s>", "é 漢 \U0001f600\n\n", "[/INS[INST]T]", None]


@given(st.text(alphabet="<s>/[]INT\\abc ", max_size=40))
@settings(max_examples=300, deadline=None)
def test_escapes_are_reversible_and_leave_no_control_string(text):
    shown = chat.escaped(text)
    assert chat.unescaped(shown) == text
    assert not any(control in shown for control, _ in chat.DEFAULT[:4])


def read(frame):
    return {r.conv_id: r for r in chat.formatted_text(chat.format_chats(frame)).collect()}


def test_round_trip(spark):
    rows = [(c, t, role, AWKWARD[(c + t) % len(AWKWARD)], "x") for c in range(10) for t, role in
            enumerate(["system", "user", "assistant", "user", "assistant"])]
    rows += [(99, None, None, None, "x"), (99, 0, "assistant", "only", "x"), (99, 0, "assistant", "only", "x"), (None, 1, "user", "q", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, input_ids string")
    found = read(frame)
    assert set(found) == {*range(10), 99, None}
    for conversation, row in found.items():
        own = sorted(((t if t is not None else -1, r or "", x or "") for c, t, r, x, _ in rows if c == conversation), key=lambda x: x[0])
        assert [(t.role, t.text) for t in row.turns] == [(r, x) for _, r, x in own]
        assert row.loss_text == "".join(x for _, r, x in own if r == "assistant")
        assert len(row.input_ids) == len(row.loss_mask)
        shown = "<s>" + "".join(f"[INST]{chat.escaped(r)}[/INST]{chat.escaped(x)}</s>" for _, r, x in own)
        assert row.formatted == shown


def test_turns_that_tie_are_ordered_the_same_in_any_layout(spark):
    rows = [(1, 0, "user", text) for text in "dbca"] + [(1, 0, "assistant", "z")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert read(frame)[1].formatted == read(frame.repartition(5))[1].formatted


def test_empty_table(spark):
    assert read(spark.createDataFrame([], "conv_id long, turn long, role string, text string")) == {}


def test_a_long_text(spark):
    text = "word </s> " * 30_000
    frame = spark.createDataFrame([(1, 0, "assistant", text)], "conv_id long, turn long, role string, text string")
    assert read(frame)[1].loss_text == text


@pytest.mark.parametrize("control", [c for c, _ in chat.DEFAULT[:4]])
def test_reserved_ids_lie_above_the_vocabulary(control):
    ids = dict(chat.DEFAULT[:4])
    assert ids[control] > chat.encoding(chat.VOCABULARY).max_token_value
