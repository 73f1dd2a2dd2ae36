"""Hashed maximum-entropy language model with a class-factored softmax, and exact unigram statistics.

log P(word | history) = sum over LEVELS of log P(class at the level | classes above, history) + log P(word | last class).
Classes are nested: a word's first class is a hash of its last bytes, the further ones are bits of its own hash, WAYS at
each level, so there are WAYS ** LEVELS last classes (the end of a text has a first class of its own). At each level
P(class | classes above, history) is a softmax over the WAYS classes inside those above. Its scores are sums of a bias and
of hashed features of the two words before: the last word, the one before it (a skip), and both together, each
joined with the classes above. The biases are the classes' shares of the training tokens and words. The weights come
from distributed gradient updates: each round every training document's feature expectations under the
present weights are summed over the cluster, and each weight moves by log(observed / expected) / (features + 1), the
scaled gradient step that never lowers the likelihood. P(word | last class) comes from the counts of all training words,
plus one each, and UNSEEN for all words of the class that were never seen.

The counts grow with the corpus without bound. The table of weights has a row for every two distinct training words, up to
MOST_ROWS, so that a task's sums of expectations fit in memory; beyond that, features share rows. Sums are made for
every TASK_TOKENS tokens or more, so what is shuffled stays a small part of the text.

Null and empty texts are one end token. Repeated rows count and are scored one by one. A null doc_id falls under the
crc32 of the empty text. An empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import cut
from ._text import SLICE_BYTES, Words, mix, slices

WAYS, LEVELS = 8, 4
BITS = WAYS.bit_length() - 1
LEAVES = WAYS**LEVELS
FEATURES = 3
#: Rows of weights (32 bytes each): least and most.
LEAST_ROWS, MOST_ROWS = 1 << 13, 1 << 17
#: Distinct words that a task gathers before it sends them on.
GATHER = 2_000_000
#: Most words in the table of frequent words that each task holds (16 bytes each); counts of others are joined.
FREQUENT = 400_000
#: Counts that each feature has in advance, dealt by the classes' shares.
SMOOTH = 50.0
#: Counts that all words of a last class which were never seen have together.
UNSEEN = 1.0
#: Numbers of a task's sums that travel in one row.
CHUNK = LEAST_ROWS * WAYS
#: Training tokens from which a task is worth sums of its own; partitions with fewer are joined.
TASK_TOKENS = 3_000_000

_CODE = np.uint64(LEAVES - 1)
_END = np.uint64(0x51A7E0F0C0DE0000) | np.uint64(LEAVES - LEAVES // WAYS)
_P = np.uint64(0x9E3779B97F4A7C15)


class Sequence:
    """Tokens of a slice of rows (an end token after each row's words): keys with the classes in the low bits."""

    def __init__(self, column: pa.Array):
        w = Words(column)
        n = len(w.first) - 1
        tail = w.hash_spans(np.maximum(w.starts, w.ends - 2), w.ends) if len(w) else np.zeros(0, np.uint64)
        kind = (tail >> np.uint64(33)) % np.uint64(WAYS - 1)
        top = np.uint64(BITS * (LEVELS - 1))
        words = (w.hashes() & ~(np.uint64(WAYS - 1) << top)) | (kind << top) if len(w) else np.zeros(0, np.uint64)
        counts = w.counts()
        self.first = np.concatenate([[0], np.cumsum(counts + 1)])
        self.keys = np.full(len(words) + n, _END, dtype=np.uint64)
        self.keys[np.arange(len(words)) + w.rows()] = words
        self.rows = np.repeat(np.arange(n), counts + 1)
        self.codes = (self.keys & _CODE).astype(np.int64)

    def features(self) -> list[np.ndarray]:
        """Hashes of the last word, the one before it, and both; fixed ones before the first word."""
        one = np.concatenate([[np.uint64(1)], self.keys[:-1]]) if len(self.keys) else self.keys
        one[self.first[:-1]] = np.uint64(1)
        two = np.concatenate([[np.uint64(2)], one[:-1]]) if len(self.keys) else self.keys
        two[self.first[:-1]] = np.uint64(2)
        return [mix(x) for x in (one, two * _P + np.uint64(5), (one * _P + two) * _P + np.uint64(9))]


class Model:
    """Weights (rows x WAYS) of all features, and biases of the classes inside each class of each level."""

    def __init__(self, rows: int, leaf_tokens: np.ndarray, leaf_words: np.ndarray):
        self.weights = np.zeros((rows, WAYS), dtype=np.float32)
        mass = leaf_tokens + leaf_words + UNSEEN
        self.within = np.log10(mass)  # what P(word | last class) divides by
        self.bias, self.nodes = [], []
        for level in range(LEVELS):
            share = mass.reshape(WAYS**level, WAYS, -1).sum(axis=2)
            self.bias.append(np.log(share / share.sum(axis=1, keepdims=True)).astype(np.float32))
            self.nodes.append(mix((np.arange(WAYS**level, dtype=np.uint64) << np.uint64(3)) + np.uint64(level + 1)))

    def places(self, found: list[np.ndarray], above: np.ndarray, level: int) -> list[np.ndarray]:
        """Row of each feature, joined with the classes above."""
        node = self.nodes[level][above]
        shift = np.uint64(64 - (len(self.weights).bit_length() - 1))
        return [(((x ^ node) * _P) >> shift).view(np.int64) for x in found]

    def level(self, found: list[np.ndarray], codes: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """The level's scores and their exponentials (WAYS x tokens), each token's class there, and its features' rows.

        Scores start at logs of shares and move by logs of ratios of counts, so their exponentials stay in range."""
        below = BITS * (LEVELS - 1 - level)
        above, mine = codes >> (below + BITS), (codes >> below) & (WAYS - 1)
        places = self.places(found, above, level)
        s = np.take(self.bias[level], above, axis=0)
        for x in places:
            s += np.take(self.weights, x, axis=0)
        s = np.ascontiguousarray(s.T)
        return s, np.exp(s), mine, places

    def log10_classes(self, found: list[np.ndarray], codes: np.ndarray) -> np.ndarray:
        """log10 of the probability of each token's last class."""
        out = np.zeros(len(codes))
        for level in range(LEVELS):
            s, e, mine, _ = self.level(found, codes, level)
            out += s[mine, np.arange(len(codes))] - np.log(e.sum(axis=0))
        return out / np.log(10.0)

    def gather(self, seq: Sequence, seen: np.ndarray | None, guess: np.ndarray) -> None:
        """Add how often the tokens' features met each class (seen), and how often the model expects it (guess); both
        are WAYS x rows."""
        found, rows = seq.features(), len(self.weights)
        for level in range(LEVELS):
            _, e, mine, places = self.level(found, seq.codes, level)
            p = np.divide(e, e.sum(axis=0), dtype=np.float64)
            for x in places:
                for c in range(WAYS):
                    guess[c] += np.bincount(x, weights=p[c], minlength=rows)
                if seen is not None:
                    np.add.at(seen.reshape(-1), mine * rows + x, 1.0)

    def move(self, seen: np.ndarray, guess: np.ndarray) -> None:
        part = SMOOTH / WAYS
        self.weights += (np.log((seen + part) / (guess + part)) / (FEATURES + 1)).astype(np.float32).T


def word_counts(docs: DataFrame) -> DataFrame:
    """(key, n) of all words and ends, gathered in each task before they are grouped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, counts = np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held])
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            return keys[at], np.add.reduceat(counts, at)

        def words(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
            for i in range(0, len(keys), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(keys[i : i + 100_000].view(np.int64)), pa.array(counts[i : i + 100_000], pa.int64())], names=["key", "n"])

        for part in slices(batches, "text", SLICE_BYTES):
            seq = Sequence(part.column("text"))
            held.append(tuple(np.unique(seq.keys, return_counts=True)))
            size += len(held[-1][0])
            if size > 2 * GATHER:
                held = [merged()]
                size = len(held[0][0])
                if size > GATHER:
                    yield from words(*held[0])
                    held, size = [], 0
        if held:
            yield from words(*merged())

    return docs.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


SUMS = "part int, chunk int, sums binary"


def expectations(docs: DataFrame, model: Model, observe: bool, tasks: int) -> DataFrame:
    """(part, chunk, sums): how often each feature meets each class under the model and, if asked, before it in the
    same vector, how often it did. At most ``tasks`` tasks; partitions are joined in place, without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for part in slices(batches, "text", SLICE_BYTES):
            if sums is None:
                sums = np.zeros((2 if observe else 1, WAYS, len(shared.value.weights)))
            shared.value.gather(Sequence(part.column("text")), sums[0] if observe else None, sums[-1])
        if sums is not None:
            flat, number = sums.astype(np.float32).reshape(-1), TaskContext.get().partitionId()
            for i in range(len(flat) // CHUNK):
                yield pa.RecordBatch.from_pydict({"part": pa.array([number], pa.int32()), "chunk": pa.array([i], pa.int32()), "sums": pa.array([flat[i * CHUNK : (i + 1) * CHUNK].tobytes()], pa.binary())})

    return docs.select("text").coalesce(tasks).mapInArrow(run, SUMS)


def total(parts: DataFrame, size: int, fan: int = 64, steps: int = 4) -> np.ndarray:
    """Sum of the tasks' vectors of ``size`` numbers, by chunks, as a tree: no group holds more than ``fan`` rows while
    there are at most ``fan`` ** ``steps`` tasks.

    The result has the model's size, which is bounded.
    """

    def add(group: pa.Table) -> pa.Table:
        sums = np.zeros(CHUNK)
        for v in group.column("sums"):
            sums += np.frombuffer(v.as_buffer(), dtype=np.float32)
        return pa.table({"part": group.column("part").slice(0, 1), "chunk": group.column("chunk").slice(0, 1), "sums": pa.array([sums.astype(np.float32).tobytes()], pa.binary())})

    for _ in range(steps):
        parts = parts.select(F.floor(F.col("part") / fan).cast("int").alias("part"), "chunk", "sums").groupBy("chunk", "part").applyInArrow(add, SUMS)
    out = np.zeros((size // CHUNK, CHUNK))
    for r in parts.select("chunk", "sums").collect():
        out[r["chunk"]] += np.frombuffer(r["sums"], dtype=np.float32)
    return out.reshape(-1)


class Scorer:
    """What a task needs to score: the model, the frequent words' counts, and the totals."""

    def __init__(self, model: Model, keys: np.ndarray, counts: np.ndarray, tokens: int, words: int):
        order = np.argsort(keys)
        self.model, self.keys, self.counts = model, keys[order], counts[order]
        self.tokens, self.words = tokens, words
        self.base = np.log10(tokens + words + 1.0)

    def rows(self, column: pa.Array) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        """n_tokens, known, base and score by row from frequent words alone; (row, key, times) of the others.

        Both scores hold log10(count + 1) of each word; the others' part of it is added once their counts are joined, and
        takes back that the score held them for words never seen.
        """
        seq = Sequence(column)
        n = len(seq.first) - 1
        keys, back = np.unique(seq.keys, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        hit = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        count = np.where(hit, self.counts[at] if len(self.keys) else 0, 0)
        seen = np.log10(count + 1.0)[back]
        lost = np.where(hit, 0.0, np.log10(UNSEEN))[back]  # until the joined counts show the word
        logs = self.model.log10_classes(seq.features(), seq.codes)
        known = np.bincount(seq.rows, weights=hit[back], minlength=n)
        base = np.bincount(seq.rows, weights=seen - self.base, minlength=n)
        score = np.bincount(seq.rows, weights=logs + seen + lost - self.model.within[seq.codes], minlength=n)
        rare = np.flatnonzero(~hit[back])
        order = np.lexsort((seq.keys[rare], seq.rows[rare]))
        row, key = seq.rows[rare][order], seq.keys[rare][order]
        fresh = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (key[1:] != key[:-1])])) if len(row) else np.zeros(0, np.int64)
        times = np.diff(np.concatenate([fresh, [len(row)]]))
        return [np.diff(seq.first), known, base, score], row[fresh], key[fresh], times


def train(docs: DataFrame, rounds: int = 2) -> tuple[Scorer, DataFrame]:
    """Model and frequent words for the tasks, and the table (key, n) of all words' counts."""
    counts = cut(word_counts(docs))
    leaves = counts.groupBy(F.col("key").bitwiseAND(LEAVES - 1).alias("c")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    leaf_tokens, leaf_words = np.zeros(LEAVES), np.zeros(LEAVES)
    for r in leaves:
        leaf_tokens[r["c"]], leaf_words[r["c"]] = r["n"], r["v"]
    tokens, words = int(leaf_tokens.sum()), int(leaf_words.sum())
    rows = min(MOST_ROWS, max(LEAST_ROWS, 1 << max(0, words // 2).bit_length()))
    model, seen = Model(rows, leaf_tokens, leaf_words), None
    for _ in range(rounds if words else 0):
        size = rows * WAYS * (2 if seen is None else 1)
        found = total(expectations(docs, model, seen is None, max(1, tokens // TASK_TOKENS)), size).reshape(-1, WAYS, rows)
        seen = found[0] if seen is None else seen
        model.move(seen, found[-1])
    # The frequent words: those whose count reaches a level that at most FREQUENT words do, found from a histogram.
    bins = counts.groupBy(F.floor(F.log2("n") * 16).alias("b")).count().orderBy(F.desc("b")).collect()
    above, level = 0, None
    for r in bins:
        above += r["count"]
        if above > FREQUENT:
            break
        level = r["b"]
    top = counts.filter(F.floor(F.log2("n") * 16) >= (level if level is not None else 2**30)).toArrow()
    keys, n = (top.column(i).to_numpy() for i in (0, 1))
    return Scorer(model, keys.view(np.uint64), n, tokens, words), counts


def scores(docs: DataFrame, held_out: Column, rounds: int = 2) -> DataFrame:
    """Score every row of ``docs`` with a model of those that the condition ``held_out`` doesn't hold."""
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    scorer, counts = train(marked.filter(~F.col("held_out")), rounds)
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    tokens = scorer.tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        at = 0
        for b in slices(batches, "text", SLICE_BYTES):
            (n, known, base, value), row, key, times = shared.value.rows(b.column("text"))
            cuts = pa.array(np.searchsorted(row, np.arange(b.num_rows + 1)), pa.int32())
            rare = pa.StructArray.from_arrays([pa.array(key.view(np.int64)), pa.array(times, pa.int32())], names=["key", "times"])
            ids = (np.int64(part) << np.int64(36)) + at + np.arange(b.num_rows)
            at += b.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), b.column("doc_id"), b.column("held_out"), pa.array(n, pa.int64()), pa.array(known, pa.float64()), pa.array(base), pa.array(value), pa.ListArray.from_arrays(cuts, rare)],
                names=["row", "doc_id", "held_out", "n_tokens", "known", "base", "value", "rare"],
            )

    first = cut(marked.mapInArrow(run, "row long, doc_id long, held_out boolean, n_tokens long, known double, base double, value double, rare array<struct<key:bigint,times:int>>"))
    rare = first.select("row", F.explode("rare").alias("r")).select("row", "r.key", "r.times")
    more = rare.join(counts, "key").groupBy("row").agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"))
    extra, known = F.coalesce("more", F.lit(0.0)), F.coalesce("more_known", F.lit(0))
    return first.join(more, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + known).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + extra).alias("base_score"),
        (F.col("value") + extra - known * F.lit(float(np.log10(UNSEEN)))).alias("score"),
    )
