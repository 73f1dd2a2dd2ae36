"""Records of capture files: the file's layout, record after record, and where records begin in the middle of a file.

A plain capture has no index. A task that starts anywhere in it guesses the first record: the first place from which
several headers in a row are plausible. A guess may be wrong (frames can hold whole captures), so it is only kept if
the block before ends exactly there; ``stitched`` compares all blocks of a file and walks the wrong ones again from
where the block before ended. So results never depend on guesses or on the size of blocks.
"""

from __future__ import annotations

import bz2
import gzip
import io
import lzma
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import cut, dealt

#: The magic numbers, with byte order and whether times count nanoseconds.
MAGICS = {b"\xd4\xc3\xb2\xa1": ("<", False), b"\xa1\xb2\xc3\xd4": (">", False), b"\x4d\x3c\xb2\xa1": ("<", True), b"\xa1\xb2\x3c\x4d": (">", True)}
FILE_HEADER, RECORD_HEADER = 24, 16
#: No record is longer; a greater length is damage, not a reason to read on.
MOST_FRAME = 1 << 18
#: Headers in a row that make a guess, and seconds that a record's time may be from the file's first.
CHAIN, NEAR_SECONDS = 8, 400 * 86400
#: Bytes read at once.
READ_BYTES = 4 << 20


class Damaged(Exception):
    """A file that can't be read on; the text says why."""


@dataclass(frozen=True)
class Layout:
    order: str
    nano: bool
    link: int

    def header(self, raw: bytes, at: int = 0) -> tuple[int, int, int]:
        """(milliseconds, length, fraction) of a record header."""
        sec, part, size, _ = struct.unpack_from(self.order + "IIII", raw, at)
        return sec * 1000 + part // (1_000_000 if self.nano else 1000), size, part


def layout(head: bytes) -> Layout:
    if len(head) < FILE_HEADER:
        raise Damaged("file header is cut off" if head else "file is empty")
    if head[:4] not in MAGICS:
        raise Damaged("not a capture")
    order, nano = MAGICS[head[:4]]
    return Layout(order, nano, struct.unpack_from(order + "I", head, 20)[0] & 0xFFFF)


def opened(path: str, raw) -> io.BufferedIOBase:
    """The file unpacked by its suffix, as a stream; gz, xz and bz2 files may hold several parts."""
    return {"gz": lambda f: gzip.GzipFile(fileobj=f), "xz": lzma.LZMAFile, "bz2": bz2.BZ2File}.get(path.rsplit(".", 1)[-1], lambda f: f)(raw)


def is_plain(path: str) -> bool:
    return path.rsplit(".", 1)[-1] not in ("gz", "xz", "bz2")


def _read(f, n: int) -> bytes:
    """At most ``n`` bytes; what an unpacker can't unpack is damage, what storage can't read stays an error."""
    try:
        return f.read(n)
    except (EOFError, zlib.error, lzma.LZMAError, gzip.BadGzipFile) as e:
        raise Damaged(f"can't be unpacked: {type(e).__name__}") from e
    except OSError as e:
        if e.errno is not None:
            raise
        raise Damaged(f"can't be unpacked: {type(e).__name__}") from e


def records(f, lay: Layout, start: int = FILE_HEADER, stop: int | None = None) -> Iterator[tuple[int, int, bytes]]:
    """(offset, milliseconds, frame) of the records that begin before ``stop``; ``f`` stands at ``start``."""
    at = start
    while stop is None or at < stop:
        head = _read(f, RECORD_HEADER)
        if not head:
            return
        if len(head) < RECORD_HEADER:
            raise Damaged("record header is cut off")
        ms, size, _ = lay.header(head)
        if size > MOST_FRAME:
            raise Damaged("record length is damaged")
        frame = _read(f, size)
        if len(frame) < size:
            raise Damaged("record is cut off")
        yield at, ms, frame
        at += RECORD_HEADER + size


def guess(raw: bytes, lay: Layout, first_second: int, ends: bool) -> int | None:
    """The first place in ``raw`` from which CHAIN plausible headers follow each other, or fewer up to the end of ``raw``
    (a chain that stops exactly there, where the file ends)."""
    n = len(raw) - RECORD_HEADER + 1
    if n <= 0:
        return None
    word = np.lib.stride_tricks.sliding_window_view(np.frombuffer(raw, np.uint8), 4)
    value = np.ascontiguousarray(word).view(lay.order + "u4")[:, 0]
    sec, part, size, whole = (value[k : k + n] for k in (0, 4, 8, 12))
    fine = (part < (1_000_000_000 if lay.nano else 1_000_000)) & (size <= MOST_FRAME) & (size <= whole) & (np.abs(sec.astype(np.int64) - first_second) <= NEAR_SECONDS)
    for at in np.flatnonzero(fine).tolist():
        place, links = at, 0
        while place < n and fine[place] and links < CHAIN:
            place, links = place + RECORD_HEADER + int(size[place]), links + 1
        if links == CHAIN or links and (place == len(raw) if ends else n <= place):
            return at
    return None


@dataclass
class Walk:
    """What a block's headers say: where its first record begins, where the next block's does, and how many there are."""

    start: int | None
    next: int | None
    records: int
    failure: str | None


def walk(f, lay: Layout, start: int, stop: int, size: int) -> Walk:
    """Step over the records that begin in [start, stop); headers are taken from large reads."""
    at, n, raw, base = start, 0, b"", start
    while at < min(stop, size):
        if at + RECORD_HEADER > base + len(raw):
            f.seek(at)
            base, raw = at, f.read(READ_BYTES)
        if at + RECORD_HEADER > size:
            return Walk(start, None, n, "record header is cut off")
        _, length, _ = lay.header(raw, at - base)
        if length > MOST_FRAME:
            return Walk(start, None, n, "record length is damaged")
        if at + RECORD_HEADER + length > size:
            return Walk(start, None, n, "record is cut off")
        at, n = at + RECORD_HEADER + length, n + 1
    return Walk(start, at, n, None)


BLOCKS = "file string, size long, block long, begin long, stop long, start long, next long, records long, failure string"
_ARROW = pa.schema([(x.split()[0], {"string": pa.string(), "long": pa.int64()}[x.split()[1]]) for x in BLOCKS.split(", ")])


def _walked(rows: DataFrame, open_file: Callable) -> DataFrame:
    """Blocks walked from ``start``, or from a guess where that is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                with open_file(row["file"]) as f:
                    yield pa.RecordBatch.from_pylist([row | walk_block(f, row).__dict__], schema=_ARROW)

    return rows.select(*_ARROW.names).mapInArrow(run, BLOCKS)


def walk_block(f, row: dict) -> Walk:
    try:
        lay = layout(f.read(FILE_HEADER))
    except Damaged as e:
        return Walk(FILE_HEADER, None, 0, str(e)) if row["block"] == 0 else Walk(None, None, 0, None)
    start = FILE_HEADER if row["block"] == 0 else row["start"]
    if start is None:
        first = f.read(RECORD_HEADER)
        if len(first) == RECORD_HEADER:
            f.seek(row["begin"])
            raw = f.read(2 * (MOST_FRAME + RECORD_HEADER))
            at = guess(raw, lay, lay.header(first)[0] // 1000, row["begin"] + len(raw) >= row["size"])
            start = None if at is None else row["begin"] + at
        if start is None:
            return Walk(None, None, 0, None)
    return walk(f, lay, start, row["stop"], row["size"])


def stitched(files: DataFrame, block_bytes: int, open_file: Callable) -> DataFrame:
    """Blocks of plain captures (file, size) with the offset and number (``first``) of their first record: those that the
    records of the file reach, exactly as one reader would walk them. A block with a ``failure`` is the file's last."""
    number = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / block_bytes))))
    rows = files.select("file", "size", number.alias("block")).withColumn("begin", F.col("block") * block_bytes).withColumn("stop", F.col("begin") + block_bytes)
    none = {c: F.lit(None).cast("long") for c in ("start", "next", "records")}
    rows = dealt(rows.withColumns({**none, "failure": F.lit(None).cast("string")}), "file", "block")
    rows = cut(_walked(rows, open_file))
    order = Window.partitionBy("file").orderBy("block")
    while True:
        seen = rows.withColumn("before", F.lag("next").over(order))
        wrong = F.col("before").isNotNull() & ~F.col("before").eqNullSafe(F.col("start"))
        seen = seen.withColumn("wrong", (F.col("block") > 0) & wrong)
        if seen.filter("wrong").isEmpty():
            break
        again = dealt(seen.filter("wrong").withColumn("start", F.col("before")), "file", "block")
        rows = cut(seen.filter("NOT wrong").select(*_ARROW.names).unionByName(_walked(again, open_file)))
    # What follows a block without an end isn't reached.
    up_to = order.rowsBetween(Window.unboundedPreceding, -1)
    reached = rows.withColumn("dead", F.coalesce(F.max(F.col("next").isNull()).over(up_to), F.lit(False))).withColumn("first", F.coalesce(F.sum("records").over(up_to), F.lit(0)))
    return reached.filter("NOT dead").drop("dead", "before", "wrong")
