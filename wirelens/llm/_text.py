"""Arrow/numpy text kernels and small session helpers shared by these operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text handled at once inside a task; a longer document is handled alone.
SLICE_BYTES = 1 << 20

#: Word separators: space and the controls 09 to 0D.
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240101)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = pow(0x9E3779B97F4A7C15, 1, 2**64) | 1
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; those for a slice are kept between calls, those for a longer text aren't."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if n <= SLICE_BYTES + 1:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shift, multiply), so that every bit depends on all others."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (from 0) of a string column; null counts as empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


#: Rows of whole texts that the JVM hands to a Python worker at once.
BATCH_ROWS = 500


def bounded(docs: DataFrame) -> DataFrame:
    """``docs``, with the session set so that batches handed to Python hold few whole texts; the default's 10,000 rows are
    held several times over, in the JVM and in each worker."""
    conf = docs.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return docs


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices whose texts hold at most ``most`` bytes together, or one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, off = utf8(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end
    pa.default_memory_pool().release_unused()  # a worker is kept for other tasks


class Words:
    """Words of a string column: ``starts``/``ends`` in bytes, ``first`` word of each row, hashes on demand."""

    def __init__(self, column: pa.Array, fold: np.ndarray = LOWER):
        raw, self.offsets = utf8(column)
        self.data = fold[raw]
        sep = SEPARATOR[self.data]
        word = ~sep
        begin, finish = word.copy(), word.copy()
        begin[1:] &= sep[:-1]
        finish[:-1] &= sep[1:]
        edge = self.offsets[1:-1]
        edge = edge[(edge > 0) & (edge < len(word))]
        begin[edge] = word[edge]
        finish[edge - 1] = word[edge - 1]
        self.starts, self.ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self._sums: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hash_spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte spans, equal for equal bytes."""
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
            np.cumsum(_BYTE[self.data] * _power(_BASE, len(self.data)), out=self._sums[1:])
        inverse = _power(_INVERSE, len(self.data) + 1)
        return mix((self._sums[ends] - self._sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))

    def hashes(self) -> np.ndarray:
        return self.hash_spans(self.starts, self.ends)


#: Keys of 8 bytes that are broadcast (some 32 MB in a task's memory); more are joined by shuffle.
BROADCAST_KEYS = 1_000_000


def checked(keys: DataFrame, n: int) -> DataFrame:
    """A column of ``n`` numbers, marked for broadcast if they are at most BROADCAST_KEYS."""
    return F.broadcast(keys) if n <= BROADCAST_KEYS else keys


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
