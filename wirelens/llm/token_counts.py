"""Token counts of documents in flat, unindexed token files, by scanning for end-of-document identifiers.

A flat file is only token identifiers, one after another, each document closed by ``separator``. Files are cut into
blocks regardless of documents. Each block is searched on its own with one vectorised comparison; a prefix scan over
the blocks' small summaries (first and last separator, number of separators) then stitches documents that cross
blocks. Token bytes are never shuffled.

An empty document is a separator right after another (0 tokens); what follows a file's last separator is an open
document, reported with closed = false if it isn't empty. Empty files and tables give no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shared import cut

BLOCK_SCHEMA = "file string, block long, ids binary"


def open_path(path: str):
    """A seekable file by URI or path; Spark's ``file:/x`` has one slash where others want three."""
    from pyarrow import fs

    if ":/" not in path:
        return fs.LocalFileSystem().open_input_file(path)
    system, name = fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
    return system.open_input_file(name)


def read_flat(spark: SparkSession, path: str, block_tokens: int = 1 << 20, width: int = 2, glob: str = "*.bin", open_file: Callable = open_path) -> DataFrame:
    """Blocks (file, block, ids) of the flat files under ``path``, of any size.

    Spark lists the files; their blocks are dealt over tasks, and each is read by its range of bytes, so one file is
    read by many tasks and none holds more than a block at a time. ``open_file`` opens a path of the listing in a task.
    """
    size = block_tokens * width
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select(F.col("path").alias("file"), "length").filter("length > 0")
    number = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / size)))
    dealt = files.select("file", number.alias("block")).repartition("file", F.floor(F.col("block") / 16))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, f = None, None
        for b in batches:
            for name, block in zip(b.column("file").to_pylist(), b.column("block").to_pylist()):
                if name != last:
                    last, f = name, open_file(name)
                f.seek(block * size)
                yield pa.RecordBatch.from_pydict({"file": [name], "block": pa.array([block], pa.int64()), "ids": pa.array([f.read(size)], pa.binary())})

    return dealt.mapInArrow(run, BLOCK_SCHEMA)


def search(blocks: DataFrame, separator: int, width: int = 2) -> DataFrame:
    """(file, block, n, places): length and separator places of each block; rows without a block pass unchanged."""
    more = [c for c in blocks.columns if c not in ("file", "block", "ids")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.dtype(f"<u{width}")
        for b in batches:
            for i in range(b.num_rows):
                ids = b.column("ids")[i]
                flat = np.frombuffer(ids.as_buffer(), dtype=kind) if ids.is_valid else None
                n, places = (None, None) if flat is None else (len(flat), np.flatnonzero(flat == separator))
                yield pa.RecordBatch.from_arrays(
                    [b.column("file").slice(i, 1), b.column("block").slice(i, 1), pa.array([n], pa.int64()), pa.array([places], pa.list_(pa.int64())), *[b.column(c).slice(i, 1) for c in more]],
                    names=["file", "block", "n", "places", *more],
                )

    extra = "".join(f", {c} {blocks.schema[c].dataType.simpleString()}" for c in more)
    return blocks.mapInArrow(run, f"file string, block long, n long, places array<long>{extra}")


def scan(blocks: DataFrame, separator: int, width: int = 2) -> DataFrame:
    """(file, ordinal, start, n_tokens, closed) of each document, in tokens from the file's start."""
    return stitch(search(blocks.select("file", "block", "ids"), separator, width))


def stitch(found: DataFrame) -> DataFrame:
    """Documents from the separators that ``search`` found.

    The prefix scan runs over each file's summaries, one small row a block: tokens, separators and the last separator. What
    it finds goes back to the blocks by (file, block), so the separators of one file are never in one task.
    """
    block = ["file", "block"]
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = found.select(*block, "n", F.size("places").alias("k"), F.try_element_at("places", F.lit(-1)).alias("end"))
    sums = sums.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("ordinal", F.coalesce(F.sum("k").over(before), F.lit(0)))
    sums = sums.withColumn("open", F.coalesce(F.max(F.col("base") + F.col("end")).over(before) + 1, F.lit(0)))
    sums = sums.withColumn("last", F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull()).drop("end", "k")
    # Each document ends at a separator and starts behind the one before, which may stand some blocks earlier.
    at = F.transform("places", lambda p: p + F.col("base"))
    stitched = found.select(*block, "places").join(sums, block).withColumn("at", at)
    starts = F.concat(F.array("open"), F.transform("at", lambda p: p + 1))
    pair = F.arrays_zip(F.slice(starts, F.lit(1), F.size("at")).alias("start"), F.col("at").alias("stop"))
    ended = stitched.select("file", "ordinal", F.posexplode(pair).alias("i", "d")).select("file", (F.col("ordinal") + F.col("i")).alias("ordinal"), F.col("d.start").alias("start"), (F.col("d.stop") - F.col("d.start")).alias("n_tokens"), F.lit(True).alias("closed"))
    final = F.try_element_at(starts, F.lit(-1))
    rest = stitched.filter("last").select("file", (F.col("ordinal") + F.size("at")).alias("ordinal"), final.alias("start"), (F.col("base") + F.col("n") - final).alias("n_tokens"), F.lit(False).alias("closed"))
    return ended.unionByName(rest.filter("n_tokens > 0"))


@lru_cache(maxsize=4)
def _encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("flat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def flat_blocks(docs: DataFrame, ranks_path: str, separator: int, block_tokens: int = 1 << 18, width: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Flat token files made of ``docs``: each input partition is a file, in blocks of ``block_tokens`` identifiers.

    Rows hold either a block (ids) or the keys of the documents that the file has, in order (keys), for the check of
    ordinals; the identifiers themselves carry no index. An identifier that ``width`` bytes can't hold is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        name = f"part-{TaskContext.get().partitionId():06d}"
        encode = _encoding(ranks_path).encode_to_numpy
        schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("ids", pa.binary()), ("ordinal", pa.int64()), ("keys", pa.list_(pa.int64()))])
        held: list[np.ndarray] = []
        size, block, ordinal = 0, 0, 0
        kind = np.dtype(f"<u{width}")
        end = np.array([separator], dtype=kind)

        def blocks(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal held, size, block
            if size < least or not size:
                return
            flat = np.concatenate(held)
            cuts = range(0, len(flat), block_tokens)
            for c in cuts:
                if len(flat) - c < block_tokens and least > 1:
                    held, size = [flat[c:]], len(flat) - c
                    return
                yield pa.RecordBatch.from_pylist([{"file": name, "block": block, "ids": flat[c : c + block_tokens].tobytes(), "ordinal": None, "keys": None}], schema=schema)
                block += 1
            held, size = [], 0

        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                for t in part.column(text).to_pylist():
                    ids = pieces(encode, t or "")
                    if len(ids) and ids.max() > np.iinfo(kind).max:
                        raise ValueError(f"identifier {ids.max()} needs more than {width} bytes")
                    ids = ids.astype(kind)
                    held += [ids, end]
                    size += len(ids) + 1
                    yield from blocks(block_tokens)
                keys = part.column(key).to_pylist()
                yield pa.RecordBatch.from_pylist([{"file": name, "block": None, "ids": None, "ordinal": ordinal, "keys": keys}], schema=schema)
                ordinal += len(keys)
        yield from blocks(1)

    return docs.select(key, text).mapInArrow(run, "file string, block long, ids binary, ordinal long, keys array<long>")


def pieces(encode, text: str, most: int = 20_000) -> np.ndarray:
    """Identifiers of a text; the splitting pattern never joins a letter or digit to a space before which it starts,
    so a very long text is encoded in parts cut before a single space that follows a letter and precedes one."""
    if len(text) <= most:
        return np.asarray(encode(text))
    out, at = [], 0
    while at < len(text):
        end = at + most
        while end < len(text) and not (text[end] == " " and text[end - 1].isalpha() and text[end + 1 : end + 2].isalpha()):
            end += 1
        out.append(np.asarray(encode(text[at:end])))
        at = end
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint32)


def document_counts(docs: DataFrame, ranks_path: str, separator: int = 50256, block_tokens: int = 1 << 18, width: int = 2) -> DataFrame:
    """(doc_id, file, ordinal, start, n_tokens) of ``docs`` by scanning the flat files made of them."""
    found = cut(search(flat_blocks(docs, ranks_path, separator, block_tokens, width), separator, width))
    counted = stitch(found.filter("block is not null").select("file", "block", "n", "places"))
    index = found.filter("keys is not null").select("file", "ordinal", F.posexplode("keys").alias("i", "doc_id")).select("file", (F.col("ordinal") + F.col("i")).alias("ordinal"), "doc_id")
    return index.join(counted, ["file", "ordinal"], "left").select("doc_id", "file", "ordinal", "start", "n_tokens")
