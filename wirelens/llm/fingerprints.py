"""Canonical exact fingerprints: Unicode normalisation, case and white-space folding, then a wide xxhash.

Null and empty texts have the fingerprint of the empty text. Repeated rows are rows of their own. An empty table
gives an empty result. Of ties in doc_id the order is by a hash of the text, then by text; a null doc_id comes last.
Further columns are left out of the result.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import cut

#: Most MB of repeated digests that are broadcast; beyond it they are joined by shuffle.
BROADCAST_MB = 32

#: Stands for a null doc_id, which comes last.
NO_ID = -(2**63)


def canonical(text: str | None) -> bytes:
    """NFKC, case folded, NFKC again (folding can undo it), runs of white space as one space, none at the ends."""
    if not text:
        return b""
    if text.isascii():
        return " ".join(text.lower().split()).encode()
    folded = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(folded.split()).encode("utf-8", "surrogatepass")


def digest(text: bytes) -> str:
    return xxhash.xxh3_128_hexdigest(text)


def with_digest(docs: DataFrame, keep_bytes: bool, column: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, digest[, canonical]) of each row; the digest is 128-bit xxh3 over the canonical bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                texts = [canonical(t) for t in part.column(column).to_pylist()]
                out = {key: part.column(key), "digest": pa.array([digest(t) for t in texts], pa.string())}
                yield pa.RecordBatch.from_pydict(out | ({"canonical": pa.array(texts, pa.binary())} if keep_bytes else {}))

    return docs.select(key, column).mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, digest string" + ", canonical binary" * keep_bytes)


def collisions(docs: DataFrame, light: DataFrame) -> DataFrame:
    """Digests shared by texts whose canonical bytes differ, found by comparing bytes inside equal buckets.

    Only rows of buckets with several rows travel with their bytes, and the smallest and largest bytes of a bucket
    are combined before the shuffle, so a bucket with a third of all rows costs two texts a task.
    """
    shared = light.groupBy("digest").agg(F.count("*").alias("_n")).filter("_n > 1").select("digest")
    shared = cut(shared)
    if shared.count() * 64 <= BROADCAST_MB << 20:
        shared = F.broadcast(shared)
    ends = with_digest(docs, True).join(shared, "digest", "left_semi").groupBy("digest").agg(F.min("canonical").alias("low"), F.max("canonical").alias("high"))
    return ends.filter("low <> high").select("digest")


#: Most digests that differing texts share and that are sent to the tasks; more would mean that the digest is unfit.
MOST_CLASHES = 100_000


def clashes(docs: DataFrame) -> frozenset[str]:
    """The digests of ``collisions``, of which a 128-bit digest has none in practice."""
    found = collisions(docs, with_digest(docs, False)).limit(MOST_CLASHES + 1).toArrow().column("digest").to_pylist()
    if len(found) > MOST_CLASHES:
        raise ValueError("too many digests are shared by texts that differ")
    return frozenset(found)


def name(clean: bytes, mark: str, odd: frozenset[str]) -> str:
    """The fingerprint: the digest, made longer by a second hash where texts that differ share it."""
    return f"{mark}-{hashlib.sha256(clean).hexdigest()}" if mark in odd else mark


def exact_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, group_id), a row for each row: group_id is the smallest doc_id with the same canonical bytes."""
    odd = clashes(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                texts = [canonical(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "fingerprint": pa.array([name(t, digest(t), odd) for t in texts], pa.string())})

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fingerprint string")
    least = named.groupBy("fingerprint").agg(F.min("doc_id").alias("group_id"))
    return named.join(least, "fingerprint").select("doc_id", "fingerprint", "group_id")


class Ranges:
    """Split points of the order (descending id, hash of the text); a row's range is how many points lie before it."""

    def __init__(self, points: list[tuple[int, int]]):
        self.down = np.array([~i for i, _ in points], dtype=np.int64)  # rises where the id falls
        self.hash = np.array([h for _, h in points], dtype=np.int64)

    def of(self, ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        down = ~ids
        low, high = np.searchsorted(self.down, down, "left"), np.searchsorted(self.down, down, "right")
        for i in np.unique(down[high > low]):  # an id that has split points of its own
            mine = down == i
            a, b = np.searchsorted(self.down, i, "left"), np.searchsorted(self.down, i, "right")
            low[mine] = a + np.searchsorted(self.hash[a:b], hashes[mine], "right")
        return low


def split_points(rows: DataFrame, n: int, parts: int, oversample: int = 20) -> list[tuple[int, int]]:
    """At most ``parts`` - 1 points of the order, from a sample of about ``oversample`` rows a range."""
    if parts <= 1:
        return []
    share = min(1.0, oversample * parts / n)
    kept = rows.filter(F.pmod(F.xxhash64(F.lit(3), "id", "hash"), F.lit(1 << 30)) < int(share * (1 << 30))).select("id", "hash").toArrow()
    seen = sorted(set(zip(kept.column("id").to_pylist(), kept.column("hash").to_pylist())), key=lambda x: (~x[0], x[1]))
    return sorted({seen[i * len(seen) // parts] for i in range(1, parts)}, key=lambda x: (~x[0], x[1])) if seen else []


def edited_pairs(docs: DataFrame, rows_per_range: int = 4000, most_ranges: int = 20_000, odd: frozenset[str] = frozenset()) -> DataFrame:
    """Fingerprints of each text and of its edit with the next document by descending doc_id.

    Rows follow each other by descending doc_id, then by a hash of the text, then by text, so that rows which share one
    doc_id can be dealt like others. They are dealt once into at most ``most_ranges`` ranges of this order; the first row
    of each range also goes to the range before, as that one's last neighbour, so one sorted pass over each range
    meets every document with its successor. Only a bounded sample of (doc_id, hash) and one key a range come to
    the driver.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    n = rows.count()
    points = split_points(rows, n, max(1, min(most_ranges, -(-n // rows_per_range))))
    shared = spark.sparkContext.broadcast(Ranges(points))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = shared.value.of(b.column("id").to_numpy(zero_copy_only=False), b.column("hash").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *b.columns], names=["range", *b.schema.names])

    fields = "range int, doc_id long, id long, hash long"
    keys = rows.select("doc_id", "id", "hash").mapInArrow(deal, fields)
    heads = sorted(tuple(r) for r in keys.groupBy("range").agg(F.min(F.struct(F.bitwise_not("id"), "hash")).alias("k")).select("range", "k.*").collect())
    parts = max(1, len(heads))
    before = [(heads[i - 1][0], ~heads[i][1], heads[i][2]) for i in range(len(heads))]
    links = spark.createDataFrame(before, "range int, id long, hash long")
    # Of several rows with a range's first key the least text comes first.
    tail = rows.join(F.broadcast(links), ["id", "hash"]).groupBy("range").agg(F.min("doc_id").alias("doc_id"), F.min("id").alias("id"), F.min("hash").alias("hash"), F.min("text").alias("text"))
    both = rows.mapInArrow(deal, f"{fields}, text string").withColumn("tail", F.lit(0)).unionByName(tail.withColumn("tail", F.lit(1)))
    both = both.repartitionByRange(parts, "range").sortWithinPartitions("range", "tail", F.desc("id"), "hash", "text").select("range", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # (range, doc_id, text, canonical, fingerprint)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                out = []
                for row in b.slice(at, 256).to_pylist():
                    clean = canonical(row["text"])
                    this = (row["range"], row["doc_id"], row["text"], clean, name(clean, digest(clean), odd))
                    if held is not None and held[0] == this[0]:
                        out.append(_edit(held, this, odd))
                    held = this
                yield pa.RecordBatch.from_pylist(out, schema=_EDITED)

    return both.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


_EDITED = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _edit(this: tuple, after: tuple, odd: frozenset[str]) -> dict:
    _, ident, text, clean, mark = this
    half = len(text) // 2
    edited = text[: len(text) - half] + after[2][:half]
    other = canonical(edited)
    return {
        "doc_id": ident,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
        "fingerprint": mark,
        "edited_fingerprint": name(other, digest(other), odd),
        "near_edited": float(other == clean),
        "near_next": float(after[3] == clean),
    }


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """``edited_pairs``, with the (never yet seen) digests of differing texts made longer."""
    return edited_pairs(docs, odd=clashes(docs))
