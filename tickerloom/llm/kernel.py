"""Vectorised text helpers shared by the operators: bytes, words, rolling hashes.

A column of texts is handled as one array of UTF-8 bytes with offsets, in slices
of a few MB, so that memory does not grow with a batch. A text larger than the
slice is a slice of its own and is processed whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20
CHUNK_BYTES = 4 << 20

_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUE = [
    _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(odd) + np.uint64(salt))
    for salt, odd in enumerate(_ODD, 17)
]
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: ``[^\x20\x09-\x0D]``
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False


def _powers(n: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(salt)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        pair = []
        base = _ODD[salt] | 1
        for m in (base, pow(base, -1, 1 << 64)):
            out = np.full(size, m, dtype=np.uint64)
            out[0] = 1
            pair.append(np.cumprod(out, dtype=np.uint64))
        have = _POWERS[salt] = (pair[0], pair[1])
    return have


class Ranges:
    """Hashes of any ranges of one value array, from a prefix sum of polynomial terms."""

    def __init__(self, values: np.ndarray, salt: int = 0) -> None:
        power, self._inverse = _powers(len(values) + 1, salt)
        self._sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * power[: len(values)], out=self._sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self._sums[end] - self._sums[start]) * self._inverse[start]
        return _mix(h + (end - start).astype(np.uint64))

    def fixed(self, length: int) -> np.ndarray:
        """Hash of every range of `length` values, by its start."""
        n = max(0, len(self._sums) - length)
        h = (self._sums[length:] - self._sums[:n]) * self._inverse[:n]
        return _mix(h + np.uint64(length))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive values, by doubling."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges ``[start, start + length)``."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def text_arrays(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def text_slices(
    column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row, bytes, offsets)`` of consecutive rows of about `limit` bytes."""
    data, at = text_arrays(column)
    first, rows = 0, len(at) - 1
    while first < rows:
        last = int(np.searchsorted(at, at[first] + limit, side="right")) - 1
        last = min(rows, max(last, first + 1))
        yield first, last, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def words(
    data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and each row's bounds in them (rows + 1 numbers)."""
    inside = word_byte[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    filled = offsets[:-1] < offsets[1:]
    at, last = offsets[:-1][filled], offsets[1:][filled] - 1
    start[at], end[last] = inside[at], inside[last]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def word_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0
) -> np.ndarray:
    return Ranges(BYTE_VALUE[salt][data], salt).hash(starts, ends)


def modest_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let this session's Arrow batches hold few rows, as these rows are whole texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)


def total_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of the whole column."""
    return docs.agg(F.sum(F.octet_length(column).cast("bigint"))).first()[0] or 0


def chunk_count(docs: DataFrame, column: str = "text", size: int = CHUNK_BYTES) -> int:
    return max(8, -(-total_bytes(docs, column) // size))


def chunk_of(n: int, *columns: str) -> Column:
    """A row's chunk: fixed by its content, so that every pass finds the same rows in it."""
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")
