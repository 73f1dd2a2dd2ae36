"""Declared templates are compared at any size of a conversation."""

import pyarrow as pa
import pytest

from wirelens.llm import chat


@pytest.mark.parametrize("late", [100, 199, 250])
def test_false_declarations_are_caught_at_any_size(monkeypatch, late):
    """Beyond VERIFIED_CHARS a template that rewrites the first turn is caught as it is below."""

    def lies(messages):
        return "".join("[old];" if i == 0 and len(messages) > late else f"{m['text']};" for i, m in enumerate(messages))

    rows = [{"conv_id": 1, "role": "u", "text": f"t{i}"} for i in range(300)]
    batch = [pa.RecordBatch.from_pylist(rows)]
    want = [(f, m, x) for _, f, m, x in chat._stream(batch, lies)]
    lies.looks_back = 0
    for most in (1 << 25, 500, 10):
        monkeypatch.setattr(chat, "VERIFIED_CHARS", most)
        assert [(f, m, x) for _, f, m, x in chat._stream(batch, lies)] == want


def test_turns_of_the_default_template_are_never_held():
    """It is made of its turns, so a conversation of any length streams, and gives what whole prefixes give."""
    rows = [{"conv_id": 1, "role": "u", "text": f"<|{i}\\"} for i in range(150)]
    taken = []

    def batches():
        for r in rows:
            taken.append(r)
            yield pa.RecordBatch.from_pylist([r])

    out = []
    for *_, x in chat._stream(batches(), chat.marked_turns):
        out.append(x)
        assert len(taken) - len(out) <= chat.WHOLE_TURNS + 1
    assert out == [x for *_, x in chat._stream([pa.RecordBatch.from_pylist(rows)], lambda m: chat.marked_turns(m))]
