"""Toxicity by a linear-chain conditional random field over words.

The table labels whole documents. Words get labels by distant supervision: a word of a toxic document is toxic if its
form, beginning or ending occurs in several toxic documents of the sample and in (almost) no clean one. The field is
trained on these sequences; forward-backward marginals then give each word's probability, which aggregate to the
document's score and the offending offsets.

Null and empty texts get the score of a text without words. Rows with null labels teach nothing; without both labels
every score is 0. Repeated rows are scored one by one; further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import Words, mix, slices

#: Hash buckets of features.
BUCKETS = 1 << 18
#: Bytes of text a task scores at once.
BATCH_BYTES = 6 << 20


def features(w: Words) -> list[np.ndarray]:
    """Buckets of each word's whole form, beginnings of 4 and 5 bytes, and ending of 4 bytes."""
    s, e = w.starts, w.ends
    spans = [(s, e), (s, np.minimum(s + 4, e)), (s, np.minimum(s + 5, e)), (np.maximum(s, e - 4), e)]
    return [((mix(w.hash_spans(a, b) + np.uint64(77 * i)) >> np.uint64(20)) % np.uint64(BUCKETS)).astype(np.int32) for i, (a, b) in enumerate(spans)]


def sliced_features(texts: pa.Array) -> list[np.ndarray]:
    """``features`` of all rows, hashed slice by slice to bound memory."""
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    parts = [features(Words(p.column("text"))) for p in slices(iter([batch]), "text")]
    return [np.concatenate(x) for x in zip(*parts)]


#: Words that a row advances in one sweep; longer rows are swept in parts of so many words at once.
PART = 1024


def marginals(odds: np.ndarray, first: np.ndarray, move: np.ndarray, start: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability of label 1 at each word by forward-backward, with the forward and backward ratios.

    With two labels the messages are ratios and a step is a 2 x 2 matrix. Rows are cut into parts of PART words that all
    advance together. In rows of several parts the product of each part's matrices carries the ratio from part to
    part first, so a sweep takes PART steps however long the longest row is. ``odds``: exp of each word's score for
    label 1; ``move[i, j]``: weight of label j after i; ``start``: weight of label 1 at the first word.
    """
    counts = np.diff(first)
    parts = -(-counts // PART)
    row = np.repeat(np.arange(len(counts)), parts)
    head = np.cumsum(parts) - parts  # each row's first part
    nth = np.arange(len(row)) - head[row]
    base = first[:-1][row] + nth * PART
    length = np.minimum(counts[row] - nth * PART, PART)
    order = np.argsort(-length, kind="stable")
    live = np.searchsorted(-length[order], -np.arange(int(length.max(initial=0))), "left")  # parts with more than t words

    def enter(forward: bool) -> np.ndarray:
        """The ratio just before each part (forward), or just behind it (backward); nan before a row's first word."""
        into = np.full(len(row), np.nan if forward else 1.0)
        many = np.flatnonzero(parts > 1)
        if not len(many):
            return into
        mine = np.flatnonzero(parts[row] > 1)
        m = np.tile(np.eye(2), (len(mine), 1, 1))  # from (1, ratio) before to (1, ratio) behind, up to a factor
        for t in range(PART) if forward else range(PART - 1, -1, -1):
            has = length[mine] > t
            o = odds[base[mine[has]] + t]
            top, low = (move[:, 0], move[:, 1]) if forward else (move[0], move[1])
            # Forward (x, y): (m00 x + m10 y, o (m01 x + m11 y)); backward: (m00 x + m01 o y, m10 x + m11 o y).
            x, y = m[has, 0], m[has, 1]
            if forward:
                new = np.stack([top[0] * x + top[1] * y, o[:, None] * (low[0] * x + low[1] * y)], axis=1)
            else:
                z = o[:, None] * y
                new = np.stack([top[0] * x + top[1] * z, low[0] * x + low[1] * z], axis=1)
            if forward and t == 0:  # a row's first word has no move before it
                fresh = nth[mine[has]] == 0
                new[fresh] = 0.0
                new[fresh, 0, 0], new[fresh, 1, 0] = 1.0, o[fresh] * start
            m[has] = new / new.sum(axis=(1, 2), keepdims=True)
        at = np.full(len(row), -1)
        at[mine] = np.arange(len(mine))
        for step in range(1, int(parts.max())):
            rows = many[parts[many] > step]
            done = head[rows] + step - 1 if forward else head[rows] + parts[rows] - step
            v = m[at[done]]
            before = np.nan_to_num(into[done])
            ratio = (v[:, 1, 0] + v[:, 1, 1] * before) / (v[:, 0, 0] + v[:, 0, 1] * before)
            into[done + 1 if forward else done - 1] = np.clip(ratio, 1e-30, 1e30)
        return into

    f, b = np.empty(len(odds)), np.ones(len(odds))
    into, r = enter(True)[order], None
    for t in range(len(live)):
        n = live[t]
        o = odds[base[order[:n]] + t]
        before = into[:n] if t == 0 else r[:n]
        new = o * (move[0, 1] + before * move[1, 1]) / (move[0, 0] + before * move[1, 0])
        if t == 0:
            new = np.where(np.isnan(before), o * start, new)
        r = np.clip(new, 1e-30, 1e30)
        f[base[order[:n]] + t] = r
    behind = enter(False)[order]
    for t in range(len(live) - 1, -1, -1):
        n = live[t]
        at, more = base[order[:n]] + t, np.arange(n) < (live[t + 1] if t + 1 < len(live) else 0)
        now = behind[:n].copy()
        inner = at[more] + 1
        z = odds[inner] * b[inner]
        now[more] = (move[1, 0] + move[1, 1] * z) / (move[0, 0] + move[0, 1] * z)
        b[at] = now
    p = f * b
    return p / (1 + p), f, b


class Tagger:
    """Weights of the field and of the document score."""

    def __init__(self):
        self.weights = np.zeros(BUCKETS, dtype=np.float32)
        self.bias, self.start = -4.0, 0.0
        self.move = np.zeros((2, 2))
        self.doc = np.array([-8.0, 0.0, 0.0])
        self.empty = True

    def words(self, w: Words, found: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        found = features(w) if found is None else found
        score = np.full(len(w), self.bias)
        for x in found:
            score += self.weights[x]
        odds = np.exp(np.clip(score, -30, 30))
        return *marginals(odds, w.first, np.exp(self.move), float(np.exp(self.start))), odds

    def summary(self, p: np.ndarray, w: Words) -> np.ndarray:
        """Per row: 1, log(1 + expected toxic words), and the largest marginal."""
        rows, n = w.rows(), len(w.first) - 1
        total = np.bincount(rows, weights=p, minlength=n)
        most = np.zeros(n)
        full = np.flatnonzero(w.counts() > 0)
        if len(full):
            most[full] = np.maximum.reduceat(p, w.first[full])
        return np.stack([np.ones(n), np.log1p(total), most], axis=1)

    def documents(self, p: np.ndarray, w: Words) -> np.ndarray:
        if self.empty:
            return np.zeros(len(w.first) - 1)
        return 1 / (1 + np.exp(-np.clip(self.summary(p, w) @ self.doc, -30, 30)))


def word_labels(found: list[np.ndarray], w: Words, toxic: np.ndarray, least: int = 4, purity: float = 0.97) -> np.ndarray:
    """Distant labels: words of toxic rows with a feature that ``least`` toxic rows and few clean ones have.

    Only features whose odds also exceed what chance gives that frequency count: 2 clean rows weigh as 1 / (1 - purity).
    """
    rows = w.rows()
    out = np.zeros(len(w), dtype=bool)
    ratio = max(1.0, (toxic == 0).sum() / max(1, (toxic == 1).sum()))
    for x in found:
        pairs = np.unique(rows.astype(np.int64) * BUCKETS + x)
        bucket, dirty = pairs % BUCKETS, toxic[pairs // BUCKETS] == 1
        a, b = np.bincount(bucket[dirty], minlength=BUCKETS), np.bincount(bucket[~dirty], minlength=BUCKETS)
        good = (a >= least) & (a * ratio / np.maximum(1e-9, a * ratio + b) >= purity) & ((b == 0) & (a * np.log1p(1 / ratio) >= 2.5) | (a >= 12))
        out |= good[x]
    return out & (toxic[rows] == 1)


def fit(texts: pa.Array, toxic: np.ndarray, rounds: int = 9) -> Tagger:
    """Train the field by full gradients of its log-likelihood (AdaGrad), then the document score."""
    tagger = Tagger()
    if not len(toxic) or toxic.min() == toxic.max():
        return tagger
    w = Words(texts)
    found = sliced_features(texts)
    gold = word_labels(found, w, toxic).astype(np.float64)
    rows = w.rows()
    inside = np.flatnonzero(rows[1:] == rows[:-1]) if len(w) else np.zeros(0, np.int64)
    heads = w.first[:-1][w.counts() > 0]
    g2, b2, m2, s2 = np.full(BUCKETS, 1e-2), 1e-2, np.full((2, 2), 1e-2), 1e-2
    n = max(1.0, gold.sum())
    for step in range(rounds):
        p, f, b, odds = tagger.words(w, found)
        miss = (gold - p) / n
        grad = sum(np.bincount(x, weights=miss, minlength=BUCKETS) for x in found) - 1e-5 * tagger.weights
        g2 += grad**2
        tagger.weights += (1.5 * grad / np.sqrt(g2) * (np.abs(grad) > 1e-7)).astype(np.float32)
        db = miss.sum()
        b2 += db**2
        tagger.bias += 0.5 * db / np.sqrt(b2)
        # Expected and seen label pairs of neighbours.
        i, j = inside, inside + 1
        z, move = odds[j] * b[j], np.exp(tagger.move)
        cell = np.stack([np.full(len(i), move[0, 0]), move[0, 1] * z, f[i] * move[1, 0], f[i] * move[1, 1] * z])
        cell /= cell.sum(axis=0)
        seen = np.stack([(1 - gold[i]) * (1 - gold[j]), (1 - gold[i]) * gold[j], gold[i] * (1 - gold[j]), gold[i] * gold[j]])
        dm = (seen.sum(axis=1) - cell.sum(axis=1)).reshape(2, 2) / n
        dm[0, 0] = 0.0
        m2 += dm**2
        tagger.move += 0.3 * dm / np.sqrt(m2)
        ds = (gold[heads] - p[heads]).sum() / n
        s2 += ds**2
        tagger.start += 0.3 * ds / np.sqrt(s2)
    tagger.empty = False
    p = tagger.words(w, found)[0]
    x, y, v = tagger.summary(p, w), toxic.astype(np.float64), np.zeros(3)
    for _ in range(25):  # Newton steps with a ridge
        q = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        v = v + np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + np.eye(3) * 0.3, x.T @ (y - q) - 0.3 * v)
    tagger.doc = v
    return tagger


def train(docs: DataFrame, labels: DataFrame, most_toxic: int = 1500, most_clean: int = 2500, longest: int = 20_000) -> Tagger:
    """Fit on a bounded sample of labelled rows: at most ``most_toxic`` and ``most_clean`` documents of at most
    ``longest`` characters, those with the least hashes of doc_id."""
    marks = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.filter(f"text is not null and length(text) <= {longest}").select("doc_id", "text")
    pick = [marks.filter(F.col("toxic") == k).orderBy(F.xxhash64(F.lit(9), "doc_id"), "doc_id").limit(n) for k, n in ((1, most_toxic), (0, most_clean))]
    chosen = rows.join(F.broadcast(pick[0].unionByName(pick[1])), "doc_id").select("doc_id", "text", "toxic").toArrow().combine_chunks()
    if not chosen.num_rows:
        return Tagger()
    chosen = chosen.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    return fit(chosen.column("text").combine_chunks(), chosen.column("toxic").to_numpy().astype(np.int64))


def score(docs: DataFrame, model: Tagger) -> DataFrame:
    """(doc_id, score, toxic_spans): code-point offsets of the words with a marginal of 0.5 or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = shared.value
        for part in slices(batches, "text", BATCH_BYTES):
            w = Words(part.column("text"))
            n = part.num_rows
            p = tagger.words(w)[0] if len(w) else np.zeros(0)
            value = tagger.documents(p, w)
            hot = np.flatnonzero(p >= 0.5) if not tagger.empty else np.zeros(0, np.int64)
            row = w.rows()[hot]
            # Code points before a byte: bytes that don't continue a character.
            head = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)]) if len(hot) else np.zeros(1, np.int64)
            base = head[w.offsets[row]] if len(hot) else hot
            spans = pa.StructArray.from_arrays([pa.array(head[w.starts[hot]] - base, pa.int32()), pa.array(head[w.ends[hot]] - base, pa.int32())], names=["start", "stop"])
            at = np.searchsorted(row, np.arange(n + 1))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(value, pa.float64()), pa.ListArray.from_arrays(pa.array(at, pa.int32()), spans)], names=["doc_id", "score", "toxic_spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, toxic_spans array<struct<start:int,stop:int>>")
