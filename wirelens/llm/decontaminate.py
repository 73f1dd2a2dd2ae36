"""Benchmark decontamination: CGK random-walk embedding, bit-sampling LSH over item-sized windows, edit verification.

Texts and items are sequences of words (A-Z lower-cased, ASCII punctuation and white space separate words). A
document matches an item of n words if some window of it is within edit distance floor(0.2 * n) of the item, that is,
alike to 0.8 or more. The CGK walk maps edit distance to Hamming distance: it copies the word under the pointer to
the output and a hash of (word, step) decides whether the pointer moves on. Each repetition walks with its own hash, from
the front or from the back, over twice as many steps as the item has words, which reaches its far end on average, and
samples ``bits`` of the steps as a bucket key; windows and items with equal keys are compared exactly.

A window within distance k of an item shares at least n - q + 1 - k * q of its q-word sequences, so windows with
fewer are left out before embedding; that loses no match. Items of one to four words allow no edit, so equal sequences of
as many words are their matches, found by hash.

Null and empty texts and items match nothing; repeated rows each match, and a null item_id stays null;
of several windows for an item the one with fewest edits, then the first, is given. An empty table on either side
gives an empty result; further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import cut
from ._text import SLICE_BYTES, Words, bounded, checked, mix, slices

#: Items of fewer words allow no edit and are matched by hash.
EDITABLE = 5
#: Items, and bytes of their texts, that are compared with all rows in one pass; more take more passes.
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 16 << 20
#: Cells of the edit matrix of one batch of candidates.
CELLS = 1 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = 0x20


def best_ends(item: np.ndarray, texts: np.ndarray, lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``texts`` (``lengths`` words of it count): edits to, and words of, the prefix that is nearest to
    ``item``, the shortest of equal ones; ``most`` + 1 edits if no prefix is within ``most``."""
    steps = np.arange(texts.shape[1] + 1, dtype=np.int32)
    edits, words = np.full(len(texts), most + 1), np.zeros(len(texts), dtype=np.int64)
    live = np.arange(len(texts))
    row = np.tile(steps, (len(texts), 1))
    for i, x in enumerate(item, 1):
        new = np.empty_like(row)
        new[:, 0] = i
        np.minimum(row[:, :-1] + (texts != x), row[:, 1:] + 1, out=new[:, 1:])
        row = np.minimum.accumulate(new - steps, axis=1) + steps
        if i % 8 == 0:
            keep = row.min(axis=1) <= most
            if not keep.all():
                row, texts, live = row[keep], texts[keep], live[keep]
            if not len(live):
                return edits, words
    row[steps > lengths[live, None]] = most + 1
    at = row.argmin(axis=1)
    best = row[np.arange(len(row)), at]
    good = best <= most
    edits[live[good]], words[live[good]] = best[good], at[good]
    return edits, words


class Texts:
    """Words of a slice of rows, read from the front or from the back."""

    def __init__(self, words: np.ndarray, first: np.ndarray):
        n = len(words)
        self.words, self.first, self.rows = words, first, np.repeat(np.arange(len(first) - 1), np.diff(first))
        back = np.concatenate([words[::-1], np.zeros(1, np.uint64)])
        self.sides = ((np.concatenate([words, np.zeros(1, np.uint64)]), first[1:][self.rows]), (back, (n - first[:-1])[self.rows][::-1]))


class Index:
    """Items in classes of like length, with the q-word sequences and LSH buckets of each class; short ones by hash."""

    def __init__(self, ids: list, hashes: list[np.ndarray], share: float, repeats: int, bits: int, seed: int):
        self.ids, self.classes, self.short = ids, [], []
        sizes = np.array([len(h) for h in hashes], dtype=np.int64)
        for n in range(1, EDITABLE):
            mine = np.flatnonzero(sizes == n)
            if len(mine):
                keys = np.array([_grams(hashes[i], n)[0] for i in mine], dtype=np.uint64)
                order = np.argsort(keys, kind="stable")
                self.short.append((n, keys[order], mine[order]))
        longest, low = int(sizes.max(initial=0)), EDITABLE
        while low <= longest:
            high = max(low + 2, int(low * 1.5))
            mine = np.flatnonzero((sizes >= low) & (sizes < high))
            if len(mine):
                self.classes.append(_Class(low, mine, [hashes[i] for i in mine], share, repeats, bits, seed))
            low = high

    def matches(self, texts: Texts) -> list[np.ndarray]:
        """Columns row, item number, edits, start and words of every window that verified."""
        found = [c.verified(texts) for c in self.classes]
        for n, keys, owner in self.short:
            grams = _grams(texts.words, n)
            at = np.flatnonzero(texts.rows[: len(grams)] == texts.rows[n - 1 :]) if len(grams) else np.zeros(0, np.int64)
            at, which = _equal(grams[at], keys, at)
            found.append([texts.rows[at], owner[which], np.zeros(len(at), np.int64), at, np.full(len(at), n)])
        return [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 5


def _equal(mine: np.ndarray, keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, index into the sorted ``keys``) of all equal pairs."""
    a, b = np.searchsorted(keys, mine, "left"), np.searchsorted(keys, mine, "right")
    some = np.flatnonzero(b > a)
    n = (b - a)[some]
    return np.repeat(places[some], n), np.repeat(a[some], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


class _Class:
    def __init__(self, low: int, numbers: np.ndarray, items: list, share: float, repeats: int, bits: int, seed: int):
        self.numbers, self.items = numbers, items
        self.sizes = np.array([len(h) for h in items])
        self.k = np.array([int(share * n) for n in self.sizes])
        self.q = 2 if low < 8 else 3
        self.least = int(max(1, (self.sizes - self.q + 1 - self.k * self.q).min()))
        self.reach = int((self.sizes + self.k).max())
        self.grams = np.unique(np.concatenate([_grams(h, self.q) for h in items]))
        self.filter = np.zeros(1 << 20, dtype=bool)
        self.filter[(self.grams >> np.uint64(44)).astype(np.int64)] = True
        ends = np.cumsum(self.sizes)
        fronts = np.concatenate([*items, np.zeros(1, np.uint64)])
        backs = np.concatenate([*(h[::-1] for h in items), np.zeros(1, np.uint64)])
        rng = np.random.default_rng([seed, low])
        self.walks = []
        for side in np.arange(repeats) % 2:
            salt, sample = np.uint64(rng.integers(1, 2**63)), np.sort(rng.choice(2 * low, size=bits, replace=False))
            keys = _walk((fronts, backs)[side], ends - self.sizes, ends, salt, sample)
            order = np.argsort(keys, kind="stable")
            self.walks.append((int(side), salt, sample, keys[order], order))

    def windows(self, texts: Texts) -> tuple[np.ndarray, np.ndarray] | None:
        """Starts, counted from the front and from the back, of windows that hold enough of the class's sequences."""
        words, first, rows = texts.words, texts.first, texts.rows
        if len(words) < self.q:
            return None
        grams = _grams(words, self.q)
        hit = np.flatnonzero(self.filter[(grams >> np.uint64(44)).astype(np.int64)])
        hit = hit[rows[hit] == rows[hit + self.q - 1]]
        place = np.minimum(np.searchsorted(self.grams, grams[hit]), len(self.grams) - 1)
        hit = hit[self.grams[place] == grams[hit]]
        if len(hit) < self.least:
            return None
        head, tail = hit[: len(hit) - self.least + 1], hit[self.least - 1 :] + self.q
        near = (tail - head <= self.reach) & (rows[head] == rows[tail - 1])
        head, tail = head[near], tail[near]
        if not len(head):
            return None
        n = len(words)
        return _covered(np.maximum(tail - self.reach, first[rows[head]]), head, n), _covered(np.maximum(n - head - self.reach, n - first[rows[head] + 1]), n - tail, n)

    def verified(self, texts: Texts) -> list[np.ndarray]:
        none = [np.zeros(0, np.int64)] * 5
        if (starts := self.windows(texts)) is None:
            return none
        out = []
        for side, (words, ends) in enumerate(texts.sides):
            found = []
            for where, salt, sample, keys, owner in self.walks:
                if where == side:
                    at, which = _equal(_walk(words, starts[side], ends[starts[side]], salt, sample), keys, starts[side])
                    found.append(at * len(self.items) + owner[which])
            pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
            out += self._compare(pairs // len(self.items), pairs % len(self.items), side, words, ends, texts)
        return [np.concatenate(x) for x in zip(*out)] if out else none

    def _compare(self, starts: np.ndarray, items: np.ndarray, side: int, words: np.ndarray, ends: np.ndarray, texts: Texts) -> list[list[np.ndarray]]:
        """Candidates whose window holds n - k words of the item go on to the edit matrix, in batches of an item."""
        out = []
        order = np.argsort(items, kind="stable")
        edges = np.searchsorted(items[order], np.arange(len(self.items) + 1))
        for i in np.flatnonzero(edges[1:] > edges[:-1]):
            item, n, k = self.items[i][:: -1 if side else 1], int(self.sizes[i]), int(self.k[i])
            known = np.unique(item)
            for part in np.array_split(starts[order[edges[i] : edges[i + 1]]], -(-int(edges[i + 1] - edges[i]) * (n + k) // CELLS)):
                places = part[:, None] + np.arange(n + k)
                length = np.minimum(ends[part] - part, n + k)
                window = words[np.minimum(places, len(words) - 1)]
                window[np.arange(n + k) >= length[:, None]] = 0
                shared = known[np.minimum(np.searchsorted(known, window), len(known) - 1)] == window
                able = shared.sum(axis=1) >= n - k
                part, window, length = part[able], window[able], length[able]
                edits, size = best_ends(item, window, length, k)
                good = edits <= k
                part, size = part[good], size[good]
                begin = len(words) - 1 - part - size if side else part
                out.append([texts.rows[np.minimum(begin, len(texts.rows) - 1)], np.full(len(part), self.numbers[i]), edits[good], begin, size])
        return out


def _covered(low: np.ndarray, high: np.ndarray, n: int) -> np.ndarray:
    """Places from 0 to n - 1 that lie in some range low..high."""
    marks = np.zeros(n + 2, dtype=np.int64)
    np.add.at(marks, low, 1)
    np.add.at(marks, np.maximum(high, low) + 1, -1)
    return np.flatnonzero(np.cumsum(marks)[:n] > 0)


def _grams(words: np.ndarray, q: int) -> np.ndarray:
    """64-bit hashes of all sequences of q words."""
    n = max(0, len(words) - q + 1)
    out = words[:n].copy()
    for i in range(1, q):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
    return mix(out)


def _walk(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: np.uint64, sample: np.ndarray) -> np.ndarray:
    """Bucket keys: the sampled outputs of the CGK walk from each start; past its end the output is 0."""
    at, key = starts.astype(np.int64), np.zeros(len(starts), dtype=np.uint64)
    wanted = set(sample.tolist())
    for step in range(int(sample[-1]) + 1):
        symbol = np.where(at < ends, words[np.minimum(at, len(words) - 1)], np.uint64(0))
        if step in wanted:
            key = key * np.uint64(0xD1342543DE82EF95) + symbol + np.uint64(1)
        stay = ((symbol ^ salt) * np.uint64(0x9E3779B97F4A7C15 + 2 * step)) >> np.uint64(63)
        at += stay.astype(np.int64)
    return mix(key)


def _verified(part: pa.RecordBatch, index: Index, key: str, text: str) -> pa.RecordBatch | None:
    w = Words(part.column(text), fold=_FOLD)
    if not len(w):
        return None
    row, item, edits, start, size = index.matches(Texts(w.hashes(), w.first))
    order = np.lexsort((size, start, edits, item, row))
    row, item, edits, start, size = (x[order] for x in (row, item, edits, start, size))
    best = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (item[1:] != item[:-1])])) if len(row) else row
    if not len(best):
        return None
    row, item, edits, start, size = (x[best] for x in (row, item, edits, start, size))
    return pa.RecordBatch.from_pydict(
        {
            key: part.column(key).take(pa.array(row)),
            "item_id": pa.array([index.ids[i][0] for i in item.tolist()], pa.int64()),
            "start_word": pa.array(start - w.first[row], pa.int64()),
            "n_words": pa.array(size, pa.int64()),
            "edits": pa.array(edits, pa.int64()),
            "similarity": pa.array(1 - edits / np.array([index.ids[i][1] for i in item.tolist()]), pa.float64()),
        }
    )


def find_leaks(docs: DataFrame, benchmark: DataFrame, share: float = 0.2, repeats: int = 40, bits: int = 3, seed: int = 5, block_items: int = BLOCK_ITEMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, edits, similarity) of documents that hold benchmark items.

    40 repetitions of 3 sampled steps, half of them from the back: a pair with all its edits at one end, in a block or
    spread meets in some repetition with probability 0.99 or more; see the recall test. Each pass over ``docs`` takes
    about ``block_items`` items of ``block_bytes`` together, which bounds what is broadcast.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null")
    n, size = items.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    parts = max(1, -(-n // block_items), -(-(size or 0) // block_bytes))
    found = None
    for p in range(parts):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == p) if parts > 1 else items
        rows = block.toArrow().combine_chunks().sort_by([("item_id", "ascending"), ("text", "ascending")])
        w = Words(rows.column("text").combine_chunks() if rows.num_rows else pa.array([], pa.string()), fold=_FOLD)
        hashes = w.hashes() if len(w) else np.zeros(0, np.uint64)
        words = [hashes[w.first[i] : w.first[i + 1]] for i in range(rows.num_rows)]
        index = Index([(i, len(h)) for i, h in zip(rows.column("item_id").to_pylist(), words)], words, share, repeats, bits, seed)
        some = _scan(docs, index)
        found = some if found is None else found.unionByName(some)
    return found


def _scan(docs: DataFrame, index: Index) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES):
            if (out := _verified(part, shared.value, "doc_id", "text")) is not None:
                yield out

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, item_id long, start_word long, n_words long, edits long, similarity double")


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; rows with a null doc_id can't be told apart and stay."""
    leaks = cut(find_leaks(bounded(docs), benchmark).select("doc_id").distinct())
    return docs.join(checked(leaks, leaks.count()), "doc_id", "left_anti")
