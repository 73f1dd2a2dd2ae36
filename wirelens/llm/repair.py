"""Conversation structure repair: a generalised LR parse of each conversation's roles, with weighted edits.

Roles (by first letter) shall spell ``(s?(ua)+)?``. The grammar is

    Talk -> (empty) | Pairs | s Pairs      Pairs -> Pair | Pairs Pair      Pair -> u a

Its LR automaton is deterministic; what makes the parse general are the edits, which follow all ways at once: keep a row
(0), give it the role user or assistant (1), delete it (2; the only way for blank and duplicate rows), insert an empty
row (5), and 5 more for a truncated row that stays. Stacks are a graph: they share what lies below their tops. What may
follow depends on a stack's top state only, so stacks with equal tops merge into the one with the least (cost, audit).
At most eight tops live at once, whatever a conversation's length, and one that costs over 10 more than the cheapest
goes: every state leads to where any other leads by edits of at most 10.

Two audits of one length of rows and one cost never begin each other, so the order of two merging audits is that of
their first difference; it is kept as a rank that is renewed row by row, and audits are never compared whole.

A conversation's rows stream through one task in order, as its digest is one hash over all of its text; the task holds
the tops and their audits (a byte a row), never texts. Rows are ordered by turn (nulls first), then role and text. Nulls
count as one space; a null conv_id is a conversation of its own; repeated rows are rows of their own (so duplicates); an
empty table gives an empty result; further columns stay behind.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._text import SLICE_BYTES, checked

#: What characters are white space, and which may end a text.
BLANKS, STOPS = " \t\n\v\f\r", ".!?"
KEEP, REROLE, DELETE, INSERT = ("K", 0), ("R", 1), ("D", 2), ("I", 5)
TRUNCATED_COST, MOST_APART = 5, 10
NAMES = {"u": "user", "a": "assistant"}
#: Rows from which a conversation's duplicates are found by grouping instead of in its task.
LARGE = 1 << 18
#: Rows after which a top's audit is packed.
PACK = 1024

#: The LR automaton: where a terminal or a reduced symbol leads, and the states that reduce (symbols, result).
_GO = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (4, "u"): 2, (6, "u"): 2, (0, "Pairs"): 4, (1, "Pairs"): 6, (0, "Pair"): 5, (1, "Pair"): 5, (4, "Pair"): 7, (6, "Pair"): 7}
_REDUCE = {3: (2, "Pair"), 5: (1, "Pairs"), 7: (2, "Pairs")}
_ACCEPT = (0, 4, 6)

Stack = tuple  # (state, stack below or None)


@lru_cache(None)
def shift(stack: Stack, terminal: str) -> Stack | None:
    """The stack after a terminal and all reductions that follow; None where the grammar has no such row."""
    if (stack[0], terminal) not in _GO:
        return None
    stack = (_GO[stack[0], terminal], stack)
    while stack[0] in _REDUCE:
        size, symbol = _REDUCE[stack[0]]
        for _ in range(size):
            stack = stack[1]
        stack = (_GO[stack[0], symbol], stack)
    return stack


class Top:
    """A stack's top with the cheapest way to it. ``order`` is (rank, letters since): audits compare as these do."""

    __slots__ = ("stack", "cost", "order", "path", "digest", "empty")

    def __init__(self, stack: Stack, cost: int, order: tuple[int, str], path, digest, empty: bool):
        self.stack, self.cost, self.order, self.path, self.digest, self.empty = stack, cost, order, path, digest, empty

    def audit(self) -> str:
        parts, path = [], self.path
        while path is not None:
            path, letters = path
            parts.append(letters)
        return "".join(reversed(parts))


class Repair:
    """One conversation's parse, fed row by row."""

    def __init__(self):
        self.tops = [Top((0, None), 0, (0, ""), None, hashlib.sha256(), True)]
        self.rows = 0

    def _inserted(self) -> dict[int, tuple]:
        """The tops and what inserted rows make of them, as (cost, order, stack, top, letters, rows) by state."""
        best = {t.stack[0]: (t.cost, t.order, t.stack, t, "", ()) for t in self.tops}
        fresh = list(best.values())
        while fresh:
            now, fresh = fresh, []
            for cost, (rank, since), stack, top, letters, rows in now:
                for initial, name in NAMES.items():
                    if (after := shift(stack, initial)) is not None:
                        way = (cost + INSERT[1], (rank, since + INSERT[0]), after, top, letters + INSERT[0], (*rows, (name, "")))
                        if after[0] not in best or way[:2] < best[after[0]][:2]:
                            best[after[0]] = way
                            fresh.append(way)
        return best

    def add(self, role: str, text: str, fault: str | None) -> None:
        best: dict[int, tuple] = {}
        extra = TRUNCATED_COST if fault == "truncated" else 0
        for cost, (rank, since), stack, top, letters, rows in self._inserted().values():
            ways = [(stack, *DELETE, None)]
            if fault not in ("blank", "duplicate"):
                ways.append((shift(stack, role[:1]), KEEP[0], KEEP[1] + extra, role))
                ways += [(shift(stack, i), REROLE[0], REROLE[1] + extra, name) for i, name in NAMES.items()]
            for after, letter, more, name in ways:
                if after is not None:
                    way = (cost + more, (rank, since + letter), after, top, letters + letter, rows if name is None else (*rows, (name, text)))
                    if after[0] not in best or way[:2] < best[after[0]][:2]:
                        best[after[0]] = way
        least = min(cost for cost, *_ in best.values())
        self.tops = [self._top(way) for way in best.values() if way[0] <= least + MOST_APART]
        self._rank()
        self.rows += 1
        if self.rows % PACK == 0:
            self._pack()

    @staticmethod
    def _top(way: tuple) -> Top:
        cost, order, stack, top, letters, rows = way
        digest, empty = top.digest.copy() if rows else top.digest, top.empty
        for name, text in rows:
            digest.update(("" if empty else "\n").encode() + f"{name}:{text}".encode())
            empty = False
        return Top(stack, cost, order, (top.path, letters) if letters else top.path, digest, empty)

    def _rank(self) -> None:
        """Equal or beginning audits share a rank and keep the letters that tell them apart; others get ranks in order."""
        rank, lead = -1, None
        for t in sorted(self.tops, key=lambda t: t.order):
            if lead is None or t.order[0] != lead[0] or not t.order[1].startswith(lead[1]):
                rank, lead = rank + 1, t.order
            t.order = (rank, t.order[1][len(lead[1]) :])

    def _pack(self) -> None:
        """Join each top's letters since the last packing, which keeps a byte a row."""
        for t in self.tops:
            parts, path = [], t.path
            while path is not None and len(path[1]) < PACK:
                path, letters = path
                parts.append(letters)
            t.path = (path, "".join(reversed(parts)))

    def close(self) -> Top:
        ends = {state: way for state, way in self._inserted().items() if state in _ACCEPT}
        return self._top(min(ends.values(), key=lambda way: way[:2]))


def fault_of(role: str, text: str, seen) -> str | None:
    """A row's first fault; ``seen(role, text)`` tells whether the conversation had it before."""
    bare = text.rstrip(BLANKS)
    again = seen(role, text)
    return "blank" if not bare else "duplicate" if again else "truncated" if bare[-1] not in STOPS else None


def damage(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) damaged by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row (no
    copies), 1 empties its text, 2 removes full stops, exclamation and question marks, 3 repeats it, 4 makes it the
    user's. Nulls count as one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(text("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text("text"), STOPS, "")).otherwise(text("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def whole(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) of conversations as they are."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"), F.lit(1).alias("copies"))


def _key() -> Column:
    return F.unhex(F.md5(F.concat_ws("\0", "role", "text").cast("binary")))


def _ordered(rows: DataFrame, large: int) -> DataFrame:
    """Rows in order, by conversation. ``first`` is the first turn with a row's role and text, in conversations of
    ``large`` rows and more (``is_large``): found by a grouping with partial sums, as a set of all would outgrow a task."""
    sizes = rows.groupBy("conv_id").agg(F.sum("copies").alias("n")).filter(F.col("n") >= large).select("conv_id", F.lit(True).alias("is_large"))
    n = sizes.count()
    if n == 0:
        rows = rows.withColumns({"first": F.lit(None).cast("long"), "is_large": F.lit(False)})
    else:
        same = F.col("conv_id").eqNullSafe(F.col("large_id"))
        rows = rows.join(checked(sizes.withColumnRenamed("conv_id", "large_id"), n), same, "left").drop("large_id").withColumn("key", F.when(F.col("is_large"), _key()))
        # Null turns come first; they count as the least number.
        turn = F.coalesce("turn", F.lit(-(2**63)))
        firsts = rows.filter("is_large AND copies > 0").groupBy(F.col("conv_id").alias("first_id"), F.col("key").alias("first_key")).agg(F.min(turn).alias("first"))
        rows = rows.join(firsts, F.col("conv_id").eqNullSafe(F.col("first_id")) & (F.col("key") == F.col("first_key")), "left").drop("first_id", "first_key", "key")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


class _Talk:
    """What a conversation's rows come to, besides their repair."""

    def __init__(self, conv_id):
        self.conv_id, self.known, self.last, self.previous = conv_id, set(), None, None
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.least = self.most = None
        self.turns = 0

    def fault(self, row: dict) -> str | None:
        role, text, turn = row["role"], row["text"], row["turn"]

        def seen(role: str, text: str) -> bool:
            if row["is_large"]:
                again = row["first"] != (turn if turn is not None else -(2**63)) or self.last == (turn, role, text)
            else:
                key = hashlib.blake2b(f"{role}\0{text}".encode(), digest_size=16).digest()
                again = key in self.known
                self.known.add(key)
            return again

        found = fault_of(role, text, seen)
        if found:
            self.counts[found] += 1
        if turn is not None and turn != self.most:
            self.turns += 1
            self.least, self.most = turn if self.least is None else self.least, turn
        self.counts["illegal"] += self.previous is not None and self.previous + role[:1] not in ("su", "ua", "au")
        self.previous, self.last = role[:1], (turn, role, text)
        return found

    def gaps(self) -> int:
        return 0 if self.least is None else self.most - self.least + 1 - self.turns


def _talks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, dict]]:
    """(opens a conversation, row)."""
    last, first = None, True
    for b in batches:
        for at in range(0, b.num_rows, 1000):
            for row in b.slice(at, 1000).to_pylist():
                yield first or row["conv_id"] != last, row
                last, first = row["conv_id"], False


REPAIR_SCHEMA = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_REPAIR_ARROW = pa.schema([("conv_id", pa.int64()), *[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("repaired_sha256", pa.string())])


def repairs(rows: DataFrame, large: int = LARGE) -> DataFrame:
    """One row per conversation of ``damage`` or ``whole``: faults, the cheapest edits and the digest of the repaired text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, talk, repair = [], 0, None, None

        def closed() -> dict:
            end = repair.close()
            return {"conv_id": talk.conv_id, "gaps": talk.gaps(), **talk.counts, "cost": end.cost, "audit": end.audit(), "repaired_sha256": end.digest.hexdigest()}

        for fresh, row in _talks(batches):
            if fresh:
                if talk is not None:
                    out.append(closed())
                    size += len(out[-1]["audit"])
                if len(out) >= 1000 or size > SLICE_BYTES:
                    yield pa.RecordBatch.from_pylist(out, schema=_REPAIR_ARROW)
                    out, size = [], 0
                talk, repair = _Talk(row["conv_id"]), Repair()
            for _ in range(row["copies"]):
                repair.add(row["role"], row["text"], talk.fault(row))
        if talk is not None:
            out.append(closed())
        yield pa.RecordBatch.from_pylist(out, schema=_REPAIR_ARROW)

    return _ordered(rows, large).mapInArrow(run, REPAIR_SCHEMA)


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, n, edit, role, text): the rows that ``repairs`` leaves, in order. Its audits travel ahead of their
    conversations' rows, so neither is held whole."""
    data = rows.filter("copies > 0").select("conv_id", F.lit(1).alias("part"), "turn", "role", "text", "copies")
    audits = found.select("conv_id", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(0).alias("copies"))
    ordered = data.unionByName(audits).repartition("conv_id").sortWithinPartitions("conv_id", "part", "turn", "role", "text")
    schema = pa.schema([("conv_id", pa.int64()), ("n", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, stack, conv, n = "", 0, (0, None), None, 0
        out, size = [], 0

        def put(edit: str, role: str, text: str) -> None:
            nonlocal n, size
            out.append({"conv_id": conv, "n": n, "edit": edit, "role": role, "text": text})
            n, size = n + 1, size + len(text)

        def follow(row: dict | None) -> None:
            """Take the audit's letters up to the one for ``row``, or the insertions that are left."""
            nonlocal at, stack
            while at < len(audit):
                letter, at = audit[at], at + 1
                if letter != DELETE[0]:
                    initial = row["role"][:1] if letter == KEEP[0] else next(i for i in NAMES if shift(stack, i))
                    stack = shift(stack, initial)
                    put(letter, row["role"] if letter == KEEP[0] else NAMES[initial], "" if letter == INSERT[0] else row["text"])
                if letter != INSERT[0]:
                    return

        for _, row in _talks(batches):
            if row["part"] == 0:
                follow(None)
                audit, at, stack, conv, n = row["text"], 0, (0, None), row["conv_id"], 0
            for _ in range(row["copies"]):
                follow(row)
            if len(out) >= 1000 or size > SLICE_BYTES:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out, size = [], 0
        follow(None)
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    return ordered.mapInArrow(run, "conv_id long, n long, edit string, role string, text string")
