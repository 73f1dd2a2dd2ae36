"""Personal data: base patterns plus a skip-chain conditional random field.

Nodes are words that hold a digit or '@'; a word without either can be none of the four kinds, so its label
is fixed and the chain is cut there exactly. Neighbouring nodes share chain potentials. Skip edges tie each node to the
one before it and to the first one with the same or a similar form (e-mail address without case, last seven digits),
however distant, so labels of repeated entities agree; two edges a node keep edges in proportion to nodes. Loopy
sum-product messages are passed in each document until they settle: exact where its edges form no cycle, and no
document's result depends on those beside it. Weights come from pseudo-likelihood training on a bounded
sample. Its labels are the base matches, carried over by the constraint that words with the same address or the same
last seven digits in one document are one entity, also where the patterns miss one of them.

Null and empty texts have no spans. Repeated rows are handled one by one. Spans are in code points, end exclusive.
Base matches always stay; the field adds words that no base match touches and whose probability is high.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._text import bounded, slices, utf8

#: Kinds in their order.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = re.compile(r"[^0-9]+")
_MARK = re.compile(r"[0-9@]")

Span = tuple[int, int, int]  # kind number, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each '@': the run of local characters before it and the longest domain after it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def ips(text: str) -> Iterator[tuple[int, int]]:
    """Parts of dotted numbers, four at a time from the left."""
    for m in _DOTTED.finditer(text):
        parts, at = m[0].split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                yield at, end
            at = end + 1


def base_spans(text: str) -> list[Span]:
    """Base matches by kind, then start."""
    out = [(0, *x) for x in emails(text)] + [(1, *x) for x in ips(text)]
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_DIGITS.sub("", m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


@dataclass
class Nodes:
    """Nodes of some texts: where they are, their feature buckets, and their chain and skip edges."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    features: np.ndarray  # nodes x FEATURES
    label: np.ndarray  # 0, or 1 + kind by the base matches
    chain: np.ndarray  # edges x 2
    skip: np.ndarray
    same: np.ndarray  # whether a skip edge is between mentions of one entity, not only of like form

    def entity_labels(self) -> np.ndarray:
        """``label``, carried from labelled mentions of an entity to the others."""
        out = self.label.copy()
        edges = self.skip[self.same].tolist()
        for a, b in [*edges, *((b, a) for a, b in reversed(edges))]:
            if out[b] == 0:
                out[b] = out[a]
        return out


FEATURES, BUCKETS = 7, 4096
LABELS = 1 + len(KINDS)


def _shape(word: str) -> list[str]:
    digits = sum(c.isdigit() for c in word)
    letters = sum(c.isalpha() for c in word)
    core = word.strip(".,;:!?\"'#*$%&=<>[]{}|")
    return [
        f"n{min(digits, 20)}",
        f"d{word.count('.')}a{int('@' in word)}h{word.count('-')}p{int('(' in word)}",
        f"l{min(letters, 12)}n{min(digits, 20)}",
        f"s{re.sub('[0-9]+', '0', re.sub('[A-Za-z]+', 'a', core))[:12]}",
        f"c{int(digits in range(16, 20) and letters == 0 and luhn(_DIGITS.sub('', word)))}n{int(digits > 12)}",
    ]


def _bucket(*parts: str) -> int:
    return zlib.crc32("\x1f".join(parts).encode("utf-8", "replace")) % BUCKETS


def similar_key(word: str) -> str:
    """Equal for words that a skip edge should tie: an address without case, or the last seven digits."""
    if "@" in word:
        return word.strip(".,;:!?<>()\"'").lower()
    digits = _DIGITS.sub("", word)
    return digits[-7:] if len(digits) >= 4 else word.lower()


def nodes_of(texts: list[str], found: list[list[Span]]) -> Nodes:
    row, start, end, feats, label, chain, skip, same = [], [], [], [], [], [], [], []
    for r, (text, spans) in enumerate(zip(texts, found)):
        cover = sorted((s, e, k) for k, s, e in spans)
        at, last, prior_word = 0, {}, ""  # last: first and latest node of each key
        before = None  # number of the node right before
        for m in _WORD.finditer(text):
            word = m[0]
            if not _MARK.search(word):
                prior_word, before = word, None
                continue
            while at < len(cover) and cover[at][1] <= m.start():
                at += 1
            k = next((k for s, e, k in cover[at : at + 4] if s < m.end() and e > m.start()), -1)
            me = len(row)
            shape = _shape(word)
            row.append(r)
            start.append(m.start())
            end.append(m.end())
            label.append(k + 1)
            feats.append([_bucket(str(i), s) for i, s in enumerate(shape)] + [_bucket("w", prior_word.lower()[-12:] if before is None else "#"), _bucket("b")])
            if before is not None:
                chain.append((before, me))
            key = similar_key(word)
            one = "@" in word or len(key) == 7 and key.isdigit()
            first, latest = last.get(key, (me, me))
            for twin in {first, latest} - {me, before}:
                skip.append((twin, me))
                same.append(one)
            last[key] = first, me
            before, prior_word = me, word
    edges = lambda x: np.array(x, dtype=np.int64).reshape(-1, 2)
    return Nodes(np.array(row, np.int64), np.array(start, np.int64), np.array(end, np.int64), np.array(feats, np.int64).reshape(-1, FEATURES), np.array(label, np.int64), edges(chain), edges(skip), np.array(same, bool))


class Field:
    """Weights of the skip-chain field: unary by feature bucket, chain by ordered labels, skip by label pair."""

    def __init__(self):
        self.unary = np.zeros((BUCKETS, LABELS))
        self.chain = np.zeros((LABELS, LABELS))
        self.skip = np.zeros((LABELS, LABELS))
        self.trained = False

    def fit(self, x: Nodes, rounds: int = 60, rate: float = 0.5, ridge: float = 1e-4) -> Field:
        """Pseudo-likelihood: each node's label given its neighbours' labels, by AdaGrad on full gradients."""
        n, label = len(x.label), x.entity_labels()
        if not n or not label.any():
            return self
        gold = np.eye(LABELS)[label]
        sums = [np.full_like(w, 1e-3) for w in (self.unary, self.chain, self.skip)]
        a, b, s, t = x.chain[:, 0], x.chain[:, 1], x.skip[:, 0], x.skip[:, 1]
        for _ in range(rounds):
            p = self.unary[x.features].sum(axis=1)
            np.add.at(p, b, self.chain[label[a]])
            np.add.at(p, a, self.chain[:, label[b]].T)
            np.add.at(p, t, self.skip[label[s]])
            np.add.at(p, s, self.skip[:, label[t]].T)
            p = np.exp(p - p.max(axis=1, keepdims=True))
            miss = (gold - p / p.sum(axis=1, keepdims=True)) / n
            unary, chain, skip = (np.zeros_like(w) for w in sums)
            for f in x.features.T:
                np.add.at(unary, f, miss)
            np.add.at(chain, label[a], miss[b])
            np.add.at(chain.T, label[b], miss[a])
            np.add.at(skip, label[s], miss[t])
            np.add.at(skip, label[t], miss[s])
            skip = (skip + skip.T) / 2
            for w, g, v in zip((self.unary, self.chain, self.skip), (unary, chain, skip), sums):
                g = g - ridge * w
                v += g * g
                w += rate * g / np.sqrt(v)
        self.trained = True
        return self

    def infer(self, x: Nodes, settled: float = 1e-7, most: int = 1000) -> np.ndarray:
        """Label probabilities by sum-product messages, until no message of a document moves by ``settled``.

        Documents without cycles are passed undamped and end after as many rounds as their longest path, exactly; others
        are damped, and left as they are after ``most`` rounds should they not settle.
        """
        unary = self.unary[x.features].sum(axis=1)
        if not self.trained:
            return np.tile(np.eye(LABELS)[0], (len(unary), 1))
        edges = np.concatenate([x.chain, x.skip])
        order = np.argsort(x.row[edges[:, 0]], kind="stable")
        kind = np.repeat([0, 1], [len(x.chain), len(x.skip)])[order]
        edges, pots = edges[order], np.stack([self.chain, self.skip])
        up, down = np.zeros((len(edges), LABELS)), np.zeros((len(edges), LABELS))  # log messages to b, to a
        row = x.row[edges[:, 0]]
        damp = np.where(_cyclic(x, edges)[row], 0.5, 0.0)[:, None] if len(edges) else np.zeros((0, 1))
        belief, live, rounds = unary.copy(), np.arange(len(edges)), 0

        def send(state: np.ndarray, pot: np.ndarray) -> np.ndarray:
            m = state[:, :, None] + pot
            top = m.max(axis=1)
            out = np.log(np.exp(m - top[:, None]).sum(axis=1)) + top
            return out - out.max(axis=1, keepdims=True)

        while len(live):
            a, b, d = edges[live, 0], edges[live, 1], damp[live]
            pot = pots[kind[live]]
            new_up = d * up[live] + (1 - d) * send(belief[a] - down[live], pot)
            new_down = d * down[live] + (1 - d) * send(belief[b] - up[live], pot.transpose(0, 2, 1))
            change = np.maximum(np.abs(new_up - up[live]), np.abs(new_down - down[live])).max(axis=1)
            up[live], down[live] = new_up, new_down
            touched = np.unique(np.concatenate([a, b]))
            belief[touched] = unary[touched]
            np.add.at(belief, b, new_up)
            np.add.at(belief, a, new_down)
            rounds += 1
            heads = np.flatnonzero(np.concatenate([[True], row[live][1:] != row[live][:-1]]))
            moving = np.maximum.reduceat(change, heads) >= settled
            if rounds >= most:
                moving &= damp[live][heads, 0] == 0
            live = live[np.repeat(moving, np.diff(np.concatenate([heads, [len(live)]])))]
        p = np.exp(belief - belief.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def _cyclic(x: Nodes, edges: np.ndarray) -> np.ndarray:
    """For each row whether its edges form a cycle: an edge that joins nodes which others already join."""
    parent = list(range(len(x.row)))
    out = np.zeros(int(x.row.max(initial=-1)) + 1, dtype=bool)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for a, b in edges.tolist():
        ra, rb = root(a), root(b)
        if ra == rb:
            out[x.row[a]] = True
        parent[max(ra, rb)] = min(ra, rb)
    return out


_EDGE = ".,;:!?\"'#*$%&=<>[]{}|"


def added_spans(texts: list[str], found: list[list[Span]], x: Nodes, p: np.ndarray, least: float) -> list[list[Span]]:
    """Words outside all base matches whose likeliest label isn't 0, with probability ``least`` or more; chained words
    of one kind are one span."""
    out: list[list[Span]] = [[] for _ in texts]
    tied = {int(b): int(a) for a, b in x.chain}
    best = p.argmax(axis=1)
    for i in np.flatnonzero((best > 0) & (p.max(axis=1) >= least) & (x.label == 0)).tolist():
        r, s, e = int(x.row[i]), int(x.start[i]), int(x.end[i])
        word = texts[r][s:e]
        s, e = s + len(word) - len(word.lstrip(_EDGE)), e - (len(word) - len(word.rstrip(_EDGE)))
        if s >= e:
            continue
        k = int(best[i]) - 1
        j = tied.get(i)
        if out[r] and j is not None and out[r][-1][0] == k and x.start[j] <= out[r][-1][1] < x.end[j]:
            out[r][-1] = (k, out[r][-1][1], e)
        elif not any(b < e and s < c for _, b, c in found[r]):
            out[r].append((k, s, e))
    return out


def train(docs: DataFrame, most_rows: int = 2000, longest: int = 20_000) -> Field:
    """Fit on at most ``most_rows`` texts of at most ``longest`` characters that hold a digit or '@' (least hashes;
    repeated texts count once)."""
    rows = docs.filter(F.col("text").rlike("[0-9@]") & (F.length("text") <= longest)).select("text", F.xxhash64(F.lit(1), "text").alias("mark"))
    chosen = rows.select("mark").distinct().orderBy("mark").limit(most_rows)  # numbers only; texts of the chosen follow
    found = rows.join(F.broadcast(chosen), "mark", "left_semi").groupBy("mark").agg(F.min("text").alias("text")).orderBy("mark")
    texts = found.toArrow().column("text").to_pylist()
    return Field().fit(nodes_of(texts, [base_spans(t) for t in texts]))


SPANS = "array<struct<kind:int,start:int,stop:int,base:boolean>>"


def spans_of(column: pa.Array, field: Field, least: float = 0.9) -> tuple[list[int], list[list[tuple[int, int, int, bool]]]]:
    """Rows that have spans, and their spans by kind and start; the last entry tells base matches."""
    raw, off = utf8(column)
    marks = np.concatenate([[0], np.cumsum((raw == 0x40) | ((raw >= 0x30) & (raw <= 0x39)))])
    rows = np.flatnonzero(marks[off[1:]] > marks[off[:-1]])
    texts = column.take(pa.array(rows)).to_pylist()
    found = [base_spans(t) for t in texts]
    x = nodes_of(texts, found)
    more = added_spans(texts, found, x, field.infer(x), least)
    out = [sorted([(*s, True) for s in a] + [(*s, False) for s in b]) for a, b in zip(found, more)]
    return rows.tolist(), out


def find(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            rows, found = spans_of(part.column(text), shared.value)
            counts = np.zeros(part.num_rows, np.int64)
            counts[rows] = [len(f) for f in found]
            flat = [s for f in found for s in f]
            cells = pa.StructArray.from_arrays([pa.array([s[i] for s in flat], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.bool_()))], names=["kind", "start", "stop", "base"])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), cells)
            yield pa.RecordBatch.from_arrays([part.column(key), lists], names=[key, "spans"])

    return docs.select(key, text).mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, spans {SPANS}")


def joined(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    kind = lambda s: F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def mask_text(text: str, spans: list[tuple[int, int, int, bool]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its (first) kind in angle brackets."""
    out, at = [], 0
    for k, s, e, _ in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"<{KINDS[k]}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with spans masked in text, and n_chars set to the new length; other columns unchanged."""
    shared = bounded(docs).sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            column = part.column("text")
            rows, found = spans_of(column, shared.value)
            new = {r: mask_text(column[r].as_py(), f) for r, f in zip(rows, found) if f}
            if not new:
                yield part
                continue
            texts = column.to_pylist()
            for r, t in new.items():
                texts[r] = t
            yield part.set_column(part.schema.get_field_index("text"), part.schema.field("text"), pa.array(texts, column.type))

    done = docs.mapInArrow(run, docs.schema)
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done
