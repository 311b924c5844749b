"""What several corpus operators share: a shared folder for tables that cut lineage, and fixed-size hashing of text bytes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from textloom.sources.shared import shared_dir

#: Bytes of text that a Python task works on at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 18

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE_KEYS = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(int(_BASE), -1, 2**64))
_GRAM_KEYS = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * _U(2) + _U(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def small_batches(spark: SparkSession) -> None:
    """Let Spark pass at most a thousand rows at a time to Python tasks of this session: texts are long, and vectors for ten thousand of them take hundreds of megabytes beside the heap."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


class Scratch:
    """Tables that ``written`` makes while this is entered, in this thread; ``settle`` removes those that are needed no more."""

    def __init__(self) -> None:
        self.paths: list[str] = []

    def __enter__(self) -> Scratch:
        self._token = _scratch.set(self)
        return self

    def __exit__(self, *_: object) -> None:
        _scratch.reset(self._token)

    def settle(self, df: DataFrame, name: str) -> DataFrame:
        """``written``; then the other tables go, as the caller says by this call that it reads none of them again."""
        out = written(df, name)
        *before, own = self.paths
        sc = df.sparkSession.sparkContext
        for path in before:
            at = sc._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)
        self.paths = [own]
        return out


_scratch: ContextVar[Scratch | None] = ContextVar("scratch", default=None)


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage is cut, and lost executors lose nothing of it.

    Results are read from such tables later, so they stay until a ``Scratch`` or whoever owns the folder removes them.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    if (scratch := _scratch.get()) is not None:
        scratch.paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string (UTF-8) or binary column end to end, and the n + 1 offsets of its rows; null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(offsets) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` bytes, or of one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads each bit of 64 over all of them."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << max(19, int(n).bit_length())
        for i, base in enumerate((_BASE, _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[i] = np.cumprod(p)
    return _powers[0][:n], _powers[1][:n]


class Words:
    """Words of some rows: ``row``, byte ``start`` and ``end`` of each, in order. Words never cross rows."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, lower: bool) -> None:
        self.data = LOWER[data] if lower else data
        inside = np.zeros(len(data) + 1, np.int8)
        inside[:-1] = is_word[self.data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        before = np.concatenate(([0], inside[:-1]))
        self.start = np.flatnonzero((inside == 1) & ((before == 0) | first))
        self.end = np.flatnonzero((before == 1) & ((inside == 0) | first))
        self.row = np.searchsorted(offsets, self.start, "right") - 1
        self.rows = len(offsets) - 1

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word."""
        power, inverse = _power(len(self.data) + 1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE_KEYS[self.data] * power[:-1])))
        return mix((total[self.end] - total[self.start]) * inverse[self.start] + (self.end - self.start).astype(np.uint64) * _BASE)

    def counts(self) -> np.ndarray:
        """Words of each row."""
        return np.bincount(self.row, minlength=self.rows)


def grams(hashes: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words within a row, and the rows."""
    if len(hashes) < n:
        return hashes[:0], row[:0]
    m = len(hashes) - n + 1
    total = np.zeros(m, np.uint64)
    for k in range(n):
        total += hashes[k : k + m] * _GRAM_KEYS[k]
    whole = row[:m] == row[n - 1 :]
    return mix(total[whole]), row[:m][whole]


def is_word(spaces: str = "", ranges: tuple[tuple[int, int], ...] = ()) -> np.ndarray:
    """Table of 256: False for bytes of ``spaces`` and of the inclusive ``ranges``. Bytes from 128 on belong to letters beyond ASCII."""
    out = np.ones(256, bool)
    out[[ord(c) for c in spaces]] = False
    for lo, hi in ranges:
        out[lo : hi + 1] = False
    return out


#: Words are runs of anything but the six ASCII white spaces.
PLAIN = is_word(" \t\n\x0b\x0c\r")
#: Words are runs of ASCII letters and digits and of all beyond ASCII.
ALNUM = is_word(ranges=((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)))
