"""Chat formatting by incremental black-box rendering.

A template is any function from a list of {role, text} messages to a string. Each conversation's turns are rendered
as growing prefixes; what a further turn adds to the output is that turn's span, and an output that doesn't begin
with the one before shows a template that rewrites history. The text's place inside the span comes from rendering
the same turn with a sentinel in place of its text; where the turn's frame depends on its text, ``located`` is false.
Prefixes are as long as the conversation, so rendering costs the square of its length. Two kinds of template need less. One
that is made of its turns (``PerTurn``) is an opening and each turn's own output by its making, so its last turn stands for
the prefix, at any length. Another may declare how many turns it looks back (``looks_back``); then prefixes are whole for the
first WHOLE_TURNS turns, and from there on as long as it says. That declaration isn't trusted: a conversation is rendered
whole at its end, and on the way each time its size has doubled, and compared with the spans, whatever its size; where they
differ the conversation is rendered again by whole prefixes. Its turns are held until then, as for any such template, which takes
the whole list.

Null roles and texts count as empty; ties in turn follow by role and text; repeated rows are turns of their own; an
empty table gives an empty result; further columns stay behind. A null conv_id is a conversation of its own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import SLICE_BYTES

#: Strings that steer chat models; inside texts and roles a backslash goes after their first character.
CONTROLS = ("<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
BEGIN, HEAD, BODY, END = "<s>", "<|turn|>", "<|text|>", "<|end|>\n"
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)

Template = Callable[[list[dict]], str]


def escape(text: str) -> str:
    """Double each backslash, then break each control string by one; ``unescape`` undoes it exactly."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class PerTurn:
    """A template that is an opening, then the output of each turn, which depends on nothing else."""

    looks_back = 0

    def __init__(self, opening: str, turn: Callable[[dict], str]):
        self.opening, self.turn = opening, turn

    def __call__(self, messages: list[dict]) -> str:
        return self.opening + "".join(map(self.turn, messages))


#: The default template: begin mark, then role, text and end mark of each turn, control strings escaped.
marked_turns = PerTurn(BEGIN, lambda m: f"{HEAD}{escape(m['role'])}{BODY}{escape(m['text'])}{END}")


#: Turns of a conversation that are rendered by whole prefixes whatever the template declares.
WHOLE_TURNS = 64
#: Characters held of a longer conversation from which it is compared with its whole rendering on the way.
VERIFIED_CHARS = 1 << 25


class Renderer:
    """Renders one conversation turn by turn and locates what each turn adds.

    Every prefix is rendered whole, so a template may look at, number or rewrite any earlier turn. A ``PerTurn`` template is
    shown its last turn and the new one. With ``trusting``, a
    template that declares ``looks_back = n`` (a turn's output depends on it and on the n turns before, besides what opens
    the conversation) is shown its last n + 1 turns from turn WHOLE_TURNS on, in memory and time that don't grow with the
    conversation; ``short`` tells that this happened.
    """

    def __init__(self, template: Template, trusting: bool = True):
        self.template = template
        self.most = None if not trusting or (back := getattr(template, "looks_back", None)) is None else max(1, back)
        self.messages: list[dict] = []
        self.output: str | None = None  # of the messages
        self.length = 0  # of the conversation's output so far
        self.turns = 0
        self.short = False
        self.exact = isinstance(template, PerTurn)  # nothing to verify

    def add(self, role: str, text: str) -> dict:
        if self.most is not None and (self.exact or self.turns >= WHOLE_TURNS) and len(self.messages) > self.most:
            self.messages, self.output, self.short = self.messages[-self.most :], None, True
        self.turns += 1
        if self.output is None:
            self.output = self.template(self.messages) if self.messages else ""
        before = self.output
        now = [*self.messages, {"role": role, "text": text}]
        after = self.template(now)
        rewrites = not after.startswith(before)
        at = len(before) if not rewrites else len(commonprefix([before, after]))
        span = after[at:]
        mark = _sentinel(after)
        probe = self.template([*self.messages, {"role": role, "text": mark}])[at:]
        start = probe.find(mark)
        tail = len(probe) - start - len(mark)
        found = start >= 0 and len(span) >= start + tail and probe[:start] == span[:start] and (tail == 0 or probe[-tail:] == span[-tail:])
        content = span[start : len(span) - tail] if found else ""
        self.messages, self.output = now, after
        first = self.length - (len(before) - at)
        self.length = first + len(span)
        return {"start": first, "span": span, "head": span[:start] if found else span, "content": content, "located": found, "rewrites": rewrites}


def _sentinel(output: str) -> str:
    """Private-use characters that the output doesn't hold."""
    n = 1
    while (mark := "\ue000" + "\ue001" * n) in output:
        n += 1
    return mark


def read_role(head: str) -> str:
    """The role that the default template's span head holds."""
    return unescape(head[head.index(HEAD) + len(HEAD) : head.rindex(BODY)])


TURN_SCHEMA = "conv_id long, n int, role string, start long, content_start long, content_end long, stop long, located boolean, rewrites boolean, span string"
DIGEST_SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites long"


def _ordered(turns: DataFrame) -> DataFrame:
    """Turns of a conversation follow each other in one task; they stream through it and are never held together."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


class _Held:
    """The turns of a long conversation, until its whole rendering has been compared with their spans."""

    def __init__(self, template: Template):
        self.template, self.renderer = template, Renderer(template)
        self.rows: list[dict] = []
        self.found: list[dict] = []
        self.size, self.given, self.compare_at = 0, 0, VERIFIED_CHARS

    def add(self, row: dict) -> None:
        self.rows.append(row)
        self.found.append(self.renderer.add(row["role"], row["text"]))
        self.size += len(row["text"]) + len(self.found[-1]["span"])

    def settled(self, closing: bool) -> Iterator[tuple[int, dict, dict]]:
        """(place, message, located span) of the turns that are final by now."""
        if self.renderer.most is not None and not self.renderer.exact:
            if not closing and self.size <= self.compare_at:
                return
            self.compare_at = 2 * self.size
            if self.renderer.short and self.template([{"role": r["role"], "text": r["text"]} for r in self.rows]) != _spelled(self.found):
                self.renderer = again = Renderer(self.template, trusting=False)
                self.found = [again.add(r["role"], r["text"]) for r in self.rows]
            elif not closing:
                return
        yield from ((self.given + i, r, x) for i, (r, x) in enumerate(zip(self.rows, self.found)))
        self.given += len(self.rows)
        self.rows, self.found = [], []


def _spelled(found: list[dict]) -> str:
    """The output that spans make: each begins at its ``start`` and replaces what stood there."""
    parts, length = [], 0
    for x in found:
        while length > x["start"]:
            last = parts.pop()
            length -= len(last)
            if length < x["start"]:
                parts.append(last[: x["start"] - length])
                length = x["start"]
        parts.append(x["span"])
        length += len(x["span"])
    return "".join(parts)


def _stream(batches: Iterator[pa.RecordBatch], template: Template) -> Iterator[tuple[object, bool, dict, dict]]:
    """(conv_id, first, message, located span) for every turn; ``first`` opens a conversation."""
    last, held = None, None

    def given(closing: bool) -> Iterator[tuple[object, bool, dict, dict]]:
        for place, row, x in held.settled(closing):
            yield last, place == 0, row, x

    for b in batches:
        for row in b.to_pylist():
            if held is None or row["conv_id"] != last:
                if held is not None:
                    yield from given(True)
                last, held = row["conv_id"], _Held(template)
            held.add(row)
            if len(held.rows) > WHOLE_TURNS:
                yield from given(False)
    if held is not None:
        yield from given(True)


def format_turns(turns: DataFrame, template: Template = marked_turns) -> DataFrame:
    """One row per turn: its span of the formatted conversation, its text's place, and whether history was rewritten.

    A span of a turn that rewrites history begins where its output leaves the one before: what earlier spans hold from
    ``start`` on no longer stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("n", pa.int32()), ("role", pa.string()), *[(k, pa.int64()) for k in ("start", "content_start", "content_end", "stop")], ("located", pa.bool_()), ("rewrites", pa.bool_()), ("span", pa.string())])
        out, n, size = [], 0, 0
        for conv, fresh, row, x in _stream(batches, template):
            n, at = 0 if fresh else n + 1, x["start"]
            begin = at + len(x["head"])
            out.append({"conv_id": conv, "n": n, "role": row["role"], "start": at, "content_start": begin, "content_end": begin + len(x["content"]), "stop": at + len(x["span"]), "located": x["located"], "rewrites": x["rewrites"], "span": x["span"]})
            size += len(x["span"])
            if len(out) >= 1000 or size > SLICE_BYTES:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out, size = [], 0
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    return _ordered(turns).mapInArrow(run, TURN_SCHEMA)


def format_digests(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation, read back from the default template's output: digests of turns and of masked text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("rewrites", pa.int64())])
        out: list[dict] = []
        held: dict | None = None

        def close() -> None:
            if held is not None:
                out.append(held | {"turns_sha256": held["turns_sha256"].hexdigest(), "loss_sha256": held["loss_sha256"].hexdigest()})

        for conv, fresh, _, x in _stream(batches, marked_turns):
            if fresh:
                close()
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
                held = {"conv_id": conv, "n_turns": 0, "turns_sha256": hashlib.sha256(), "loss_chars": 0, "loss_sha256": hashlib.sha256(), "formatted_chars": 0, "rewrites": 0}
            role, text = read_role(x["head"]), unescape(x["content"])
            held["n_turns"] += 1
            held["turns_sha256"].update(f"{role}\n{text}\n".encode())
            held["formatted_chars"] += len(x["span"])
            held["rewrites"] += x["rewrites"]
            if role == loss_role:
                held["loss_chars"] += len(text)
                held["loss_sha256"].update(text.encode())
        close()
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    return _ordered(turns).mapInArrow(run, DIGEST_SCHEMA)
