"""Hash tables spread over the cluster, exchanged as packed arrays.

Chunks of documents ask about 128-bit keys. Every chunk asks for a key at most once and
with what it already knows, so that a key of any frequency costs a bucket one entry a
chunk. Keys are dealt to buckets by their bits; a bucket joins what the chunks know and
answers each of them. Keys travel as numpy arrays in binary columns: one row a chunk
and bucket in place of a row a key.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: A chunk's questions to a bucket; `known` holds one number a key.
ASK = "bucket int, chunk int, high binary, low binary, known binary"
ANSWER = "chunk int, high binary, low binary, value binary"
#: Keys for which a bucket is laid out; it bounds a task's memory to about 100 MB.
BUCKET_KEYS = 1 << 20


def bucket_count(keys: int) -> int:
    """A power of two."""
    n = 1
    while n * BUCKET_KEYS < keys:
        n *= 2
    return max(8, n)


def pack(
    chunk: int, buckets: int, high: np.ndarray, low: np.ndarray, known: np.ndarray
) -> list[tuple]:
    """Rows of `ASK` for one chunk's distinct keys."""
    bucket = (high & np.uint64(buckets - 1)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    out = []
    for b in np.flatnonzero(edges[:-1] < edges[1:]):
        at = order[edges[b] : edges[b + 1]]
        out.append((int(b), chunk, high[at].tobytes(), low[at].tobytes(), known[at].tobytes()))
    return out


def groups(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that brings equal keys together, and the group number of each ordered key."""
    order = np.lexsort((low, high))
    h, lo = high[order], low[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (lo[1:] != lo[:-1])
    return order, np.cumsum(new) - 1


def joined(series: pd.Series, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(series), kind)


def exchange(
    asked: DataFrame,
    combine: np.ufunc,
    tells: Callable[[np.ndarray, np.ndarray], np.ndarray],
    low_type: type = np.uint64,
    known_type: type = np.int64,
) -> DataFrame:
    """Rows of `ANSWER`: per chunk the keys whose joint value tells it something.

    `combine` joins what the chunks know about a key; ``tells(known, joint)`` says for
    which entries the answer goes back. Shorter types make for less to move.
    """

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        high, low = joined(frame["high"], np.uint64), joined(frame["low"], low_type)
        known = joined(frame["known"], known_type).astype(np.int64)
        chunk = np.repeat(frame["chunk"].to_numpy(), frame["high"].str.len() // 8)
        order, group = groups(high, low)
        first = np.flatnonzero(np.diff(group, prepend=-1))
        joint = combine.reduceat(known[order], first)[group] if len(first) else known
        told = tells(known[order], joint)
        at, joint = order[told], joint[told]
        by = np.argsort(chunk[at], kind="stable")
        at, joint = at[by], joint[by]
        edges = np.flatnonzero(np.diff(chunk[at], prepend=-1))
        rows = [
            (int(chunk[at[a]]), high[at[a:b]].tobytes(), low[at[a:b]].tobytes(), joint[a:b].astype(known_type).tobytes())
            for a, b in zip(edges, [*edges[1:], len(at)], strict=True)
        ]
        return pd.DataFrame(rows, columns=["chunk", "high", "low", "value"])

    return asked.groupBy("bucket").applyInPandas(merge, ANSWER)


class Told:
    """The answers one chunk got, for lookups by key."""

    def __init__(
        self,
        high: bytes,
        low: bytes,
        value: bytes,
        low_type: type = np.uint64,
        value_type: type = np.int64,
    ) -> None:
        keys = np.frombuffer(high, np.uint64)
        order = np.argsort(keys, kind="stable")
        self._high = keys[order]
        self._low = np.frombuffer(low, low_type)[order]
        self._value = np.frombuffer(value, value_type).astype(np.int64)[order]

    def find(self, high: np.ndarray, low: np.ndarray, missing: int) -> np.ndarray:
        out = np.full(len(high), missing, np.int64)
        if not len(self._high) or not len(high):
            return out
        at = np.searchsorted(self._high, high)
        # equal high halves with other low halves: look on, as far as such a run goes
        open_ = np.arange(len(high))
        while len(open_):
            k = at[open_]
            inside = k < len(self._high)
            open_, k = open_[inside], k[inside]
            same = self._high[k] == high[open_]
            open_, k = open_[same], k[same]
            hit = self._low[k] == low[open_]
            out[open_[hit]] = self._value[k[hit]]
            open_ = open_[~hit]
            at[open_] += 1
        return out
