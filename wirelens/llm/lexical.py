"""Ranked lexical search: a hybrid of term-at-a-time and document-at-a-time scoring.

Every document is read once and becomes one row of its query terms' counts (its postings), written to the shared
folder. Counts of documents, terms and documents per term are taken from there over all rows. Each task then keeps an
index of a block of documents at a time. For an item, the lists that are short in the block are summed term at a time
into accumulators (document, sum). The accumulators are one more iterator beside the long lists: like these, it has a
bound for each range of documents. Ranges whose bounds together don't reach the item's threshold are skipped in all lists;
in the others each document gets its whole score from all iterators before the next. The threshold starts from the accumulators, is
carried from block to block, and only rises. What tasks return is at most k rows an item, of which a grouped sort keeps k.

Bounds are sums of real scores' largest values and ties with the threshold are visited, so results are exact. Items are
taken in groups whose texts hold at most ``GROUP_BYTES`` together, which bounds what is broadcast and what a task holds.

A null or empty text has no terms and is in no list, a null item likewise; equal scores follow by ascending doc_id, null
last; repeated rows are documents, repeated items items of their own (rank counts per item_id and text); an empty table
gives an empty result; further columns stay behind.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import cut
from ._text import slices

#: Terms of lower-cased UTF-8 bytes: letters, digits and all that isn't ASCII.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_BREAK = re.compile(rb"[^0-9a-z\x80-\xff]")
#: Bytes of a text that are cut into terms at once; a text is cut between terms only.
PIECE_BYTES = 1 << 20
#: Bytes of items searched in one pass over the documents.
GROUP_BYTES = 32 << 20
#: Postings of a block (some 24 bytes each), documents of a range, and postings in a block up to which a list is short.
BLOCK_POSTINGS, RANGE, SHORT = 1 << 21, 128, 64
#: Blocks of a task, where there are more than the cluster's cores take at once; the more, the fewer rows are returned.
TASK_BLOCKS = 64
#: Parts that an item's rows are dealt to before the last sort.
PARTS = 64


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, a piece of it at a time."""
    raw, at = (text or "").encode().lower(), 0
    while at < len(raw):
        found = _BREAK.search(raw, at + PIECE_BYTES) if len(raw) - at > PIECE_BYTES else None
        end = found.start() if found else len(raw)
        yield TERM.findall(raw, at, end)
        at = end


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, term, tf) of documents with a term: number of all their terms with repeats, and the vocabulary's
    terms in them with their counts, ascending."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size = shared.value.get, len(shared.value)
        for part in slices(batches, "text"):
            lengths, found, rows = [], [], []
            for row, text in enumerate(part.column("text").to_pylist()):
                n = 0
                for piece in terms(text):
                    n += len(piece)
                    ids = np.array([i for i in map(number, piece) if i is not None], np.int64)
                    found.append(ids + row * size)
                lengths.append(n)
            keys, counts = np.unique(np.concatenate([*found, np.zeros(0, np.int64)]), return_counts=True)
            edges = np.searchsorted(keys, np.arange(len(lengths) + 1) * size)
            rows = pa.array([n > 0 for n in lengths])
            lists = [pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(x.astype(np.int32))) for x in (keys % max(size, 1), counts)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(lengths, pa.int64()), *lists], ["doc_id", "n", "term", "tf"]).filter(rows)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, term array<int>, tf array<int>")


def document_frequencies(rows: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each of ``size`` terms: each task counts its rows in one array, sums are grouped by term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            total += np.bincount(b.column("term").flatten().to_numpy(), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(held, pa.int64()), "df": pa.array(total[held], pa.int64())})

    found = rows.select("term").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(size, np.int64)
    out[found.column("term").to_numpy()] = found.column("df").to_numpy()
    return out


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)


class Best:
    """The best ``k`` (score, doc_id) so far of each item; ``floor`` is the score that a document must reach."""

    def __init__(self, k: int, items: int):
        self.k = k
        self.scores = [np.zeros(0, np.int64)] * items
        self.ids = [np.zeros(0, np.int64)] * items

    def floor(self, item: int) -> int:
        return int(self.scores[item][-1]) if len(self.scores[item]) == self.k else 1

    def offer(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        keep = scores >= self.floor(item)
        if keep.any():
            s, d = np.concatenate([self.scores[item], scores[keep]]), np.concatenate([self.ids[item], ids[keep]])
            order = np.lexsort((d, -s))[: self.k]
            self.scores[item], self.ids[item] = s[order], d[order]


#: A null doc_id sorts behind all others.
NO_ID = np.iinfo(np.int64).max


class Block:
    """An inverted index over one block of documents: postings by term, then document, with what each adds to a score."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, counts: np.ndarray, term: np.ndarray, tf: np.ndarray, weight: np.ndarray, n_docs: int, n_terms: int):
        self.ids = ids
        m = np.array([50 + 50 * x * n_docs // n_terms for x in n.tolist()], np.int64)  # Python's numbers don't overflow
        doc = np.repeat(np.arange(len(ids)), counts)
        order = np.argsort(term, kind="stable")
        self.doc, term, tf = doc[order], term[order], tf[order].astype(np.int64)
        self.gain = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[self.doc]))
        self.start = np.searchsorted(term, np.arange(len(weight) + 1))
        self.ranges = -(-len(ids) // RANGE)
        self.skips: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def long_list(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """Of a long list: where each range of documents begins in it, and the largest gain of each range."""
        if term not in self.skips:
            a, b = self.start[term], self.start[term + 1]
            edges = a + np.searchsorted(self.doc[a:b], np.arange(self.ranges + 1) * RANGE)
            self.skips[term] = edges, _largest(self.gain[a:b], edges - a)
        return self.skips[term]

    def search(self, item: int, wanted: np.ndarray, best: Best) -> int:
        """Offer all documents that can be among the item's best; the number of ranges that were visited."""
        size = self.start[wanted + 1] - self.start[wanted]
        short, long = wanted[(size > 0) & (size <= SHORT)], wanted[size > SHORT]
        # Term at a time: the short lists become accumulators, one sum a document.
        places = np.concatenate([np.arange(self.start[t], self.start[t + 1]) for t in short.tolist()] or [np.zeros(0, np.int64)])
        held, at = np.unique(self.doc[places], return_inverse=True)
        sums = np.zeros(len(held), np.int64)
        np.add.at(sums, at, self.gain[places])
        if not len(long):
            best.offer(item, sums, self.ids[held])
            return 0
        # The accumulators are an iterator with bounds, like the long lists.
        edges = np.searchsorted(held, np.arange(self.ranges + 1) * RANGE)
        bound = _largest(sums, edges)
        lists = [self.long_list(t) for t in long.tolist()]
        for _, top in lists:
            bound = bound + top
        floor = best.floor(item)
        if len(sums) >= best.k:  # partial sums are reached by whole scores
            floor = max(floor, int(np.partition(sums, len(sums) - best.k)[len(sums) - best.k]))
        # Document at a time: over the ranges that may reach the threshold, the rest is skipped in all lists.
        seen = 0
        for r in np.flatnonzero(bound >= floor).tolist():
            if bound[r] < max(floor, best.floor(item)):
                continue
            seen += 1
            first = r * RANGE
            score = np.zeros(min(RANGE, len(self.ids) - first), np.int64)
            a, b = edges[r], edges[r + 1]
            score[held[a:b] - first] = sums[a:b]
            for starts, _ in lists:
                a, b = starts[r], starts[r + 1]
                score[self.doc[a:b] - first] += self.gain[a:b]
            hit = np.flatnonzero(score > 0)
            best.offer(item, score[hit], self.ids[first + hit])
        return seen


def _largest(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The largest of each run between two edges; 0 where there is none."""
    out = np.zeros(len(edges) - 1, np.int64)
    some = np.flatnonzero(edges[1:] > edges[:-1])
    if len(some):
        out[some] = np.maximum.reduceat(values, edges[:-1][some])
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Documents gathered until they hold ``BLOCK_POSTINGS``; one that holds more is a block of its own."""
    held, size = [], 0

    def joined():
        return tuple(np.concatenate(x) for x in zip(*held))

    for b in batches:
        counts = b.column("term").value_lengths().to_numpy()
        ends = np.cumsum(counts)
        at = 0
        while at < b.num_rows:
            before = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + BLOCK_POSTINGS, "right")))
            part = b.slice(at, end - at)
            held.append((part.column("doc_id").fill_null(NO_ID).to_numpy(), part.column("n").to_numpy(), counts[at:end], part.column("term").flatten().to_numpy(), part.column("tf").flatten().to_numpy()))
            size += int(ends[end - 1] - before)
            at = end
            if size >= BLOCK_POSTINGS:
                yield joined()
                held, size = [], 0
    if held:
        yield joined()


def _group(docs: DataFrame, items: list[tuple[int | None, str | None]], first: int, k: int) -> DataFrame:
    """(item, item_id, doc_id, score) of one group of items: at most k rows an item and task."""
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    wanted = [np.unique(np.array([vocabulary.setdefault(t, len(vocabulary)) for piece in terms(text) for t in piece], np.int64)) for _, text in items]
    rows = cut(postings(docs, vocabulary))
    n_docs, n_terms, n_postings = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.size("term")), F.lit(0))).first()
    weight = weights(n_docs, document_frequencies(rows, len(vocabulary)))
    shared = spark.sparkContext.broadcast(([i for i, _ in items], wanted, weight, n_docs, n_terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, wanted, weight, n_docs, n_terms = shared.value
        best = Best(k, len(names))
        for ids, n, counts, term, tf in _blocks(batches):
            block = Block(ids, n, counts, term, tf, weight, n_docs, n_terms)
            for item, query in enumerate(wanted):
                block.search(item, query, best)
        for item, name in enumerate(names):
            if len(best.scores[item]):
                ids = best.ids[item]
                doc = pa.array(ids, pa.int64(), mask=ids == NO_ID)
                yield pa.RecordBatch.from_pydict({"item": pa.array([first + item] * len(ids), pa.int64()), "item_id": pa.array([name] * len(ids), pa.int64()), "doc_id": doc, "score": pa.array(best.scores[item], pa.int64())})

    tasks = max(spark.sparkContext.defaultParallelism, n_postings // (TASK_BLOCKS * BLOCK_POSTINGS))
    return rows.coalesce(tasks).mapInArrow(run, "item long, item_id long, doc_id long, score long")


def search(docs: DataFrame, queries: DataFrame, k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each row of ``queries`` (item_id, text)."""
    rows = queries.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text IS NOT NULL")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    groups, found, first = -(-size // GROUP_BYTES) or 1, None, 0
    for g in range(groups):
        some = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == g) if groups > 1 else rows
        items = [(r["item_id"], r["text"]) for r in some.orderBy("item_id", "text").toLocalIterator()]
        part = _group(docs, items, first, k)
        first += len(items)
        found = part if found is None else found.unionByName(part)
    best = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = Window.partitionBy("item", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))).orderBy(*best)
    order = Window.partitionBy("item").orderBy(*best)
    found = found.withColumn("place", F.row_number().over(part)).filter(F.col("place") <= k)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
