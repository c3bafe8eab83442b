"""Operator 7, substring dedup: a count-min prefilter, then exact grouping.

A window of 50 words is represented in the sketch by its anchor, the smallest hash of
the 25-word strings in it. Equal windows have equal anchors, so an anchor counts at
least as often as any window it stands for: an overestimate, as the sketch's own.
Windows whose anchor is estimated to occur once are unique; all others are grouped
exactly by 128-bit hashes of their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm import kernel as K
from tickerloom.llm.countmin import MAX_CELLS_LOG2, estimated_repeated, of_texts, repeated_cells
from tickerloom.llm.exchange import ASK, Told, bucket_count, exchange, groups, pack

WINDOW = 50
NO_DOC = np.iinfo(np.int64).max


class Windows:
    """The windows of some rows: first word, anchor, and row of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int) -> None:
        self.starts, self.ends, self.bounds = K.words(data, offsets, K.NOT_BLANK)
        per_row = np.maximum(np.diff(self.bounds) - window + 1, 0)
        self.at = K.ragged(self.bounds[:-1], per_row)
        self.row = np.repeat(np.arange(len(per_row)), per_row)
        self._data, self._window = data, window
        self._word = K.word_hashes(data, self.starts, self.ends)
        half = window // 2
        grams = K.Ranges(self._word).fixed(half)
        smallest = K.sliding_min(grams, window - half + 1) if len(self.at) else grams
        self.anchor = smallest[self.at]

    def keys(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128-bit keys of the chosen windows."""
        at = self.at[chosen]
        other = K.word_hashes(self._data, self.starts, self.ends, 1)
        return (
            K.Ranges(self._word).hash(at, at + self._window),
            K.Ranges(other, 1).hash(at, at + self._window),
        )


def _ids(table: pa.Table) -> np.ndarray:
    """Document ids; null stands behind all others."""
    return table.column("doc_id").fill_null(NO_DOC).to_numpy()


def _slices(table: pa.Table) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    return K.text_slices(table.column("text"))


def repeated_words(
    docs: DataFrame, window: int = WINDOW, max_cells_log2: int = MAX_CELLS_LOG2
) -> DataFrame:
    """Per row: id, number of words, number removed, and the text of the words kept.

    A word goes when a window over it also starts in a document with a smaller id. Null
    text has no words; a null id counts as larger than all ids, rows of one id as one
    document. Texts shorter than a window stay. Kept words are joined by one space.
    """
    K.modest_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    size = K.total_bytes(rows)
    chunks = max(8, -(-size // K.CHUNK_BYTES))
    buckets = bucket_count(size // 16)
    log2 = min(max_cells_log2, max(12, int(size).bit_length() - 2))

    def counted(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One anchor a run of windows that share it."""
        w = Windows(data, offsets, window)
        first = np.ones(len(w.at), bool)
        first[1:] = (w.anchor[1:] != w.anchor[:-1]) | (w.row[1:] != w.row[:-1])
        return w.anchor[first]

    shared = docs.sparkSession.sparkContext.broadcast(repeated_cells(rows.select("text"), of_texts(counted), log2))
    chunked = rows.withColumn("chunk", K.chunk_of(chunks, "doc_id", "text"))

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        ids = _ids(table)
        for first, last, data, offsets in _slices(table):
            w = Windows(data, offsets, window)
            chosen = estimated_repeated(w.anchor, shared.value, log2)
            if chosen.any():
                found.append((*w.keys(chosen), ids[first:last][w.row[chosen]]))
        asked = []
        if found:
            high, low, doc = (np.concatenate(c) for c in zip(*found, strict=True))
            order, group = groups(high, low)
            first_of = np.flatnonzero(np.diff(group, prepend=-1))
            least = np.minimum.reduceat(doc[order], first_of)
            at = order[first_of]
            asked = pack(key[0].as_py(), buckets, high[at], low[at], least)
        columns = list(zip(*asked, strict=True)) if asked else [[], [], [], [], []]
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.table(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
            names=["bucket", "chunk", "high", "low", "known"],
        )

    asked = chunked.groupBy("chunk").applyInArrow(ask, ASK)
    answers = exchange(asked, np.minimum, lambda known, joint: joint < known)

    def remove(table: pa.Table, told: pa.Table) -> pa.Table:
        told_keys = Told(*(b"".join(told.column(c).to_pylist()) for c in ("high", "low", "value")))
        ids = _ids(table)
        held = []
        for first, last, data, offsets in _slices(table):
            w = Windows(data, offsets, window)
            chosen = np.flatnonzero(estimated_repeated(w.anchor, shared.value, log2))
            doc = ids[first:last][w.row[chosen]]
            held.append((data, offsets, w.starts, w.ends, w.bounds, w.at[chosen], doc, *w.keys(chosen)))
        least = _least_doc(held, told_keys)
        n_words, n_removed, texts = [], [], []
        for (data, offsets, starts, ends, bounds, at, doc, _, _), low in zip(held, least, strict=True):
            gone = np.zeros(len(starts) + 1, np.int64)
            hit = at[low < doc]
            np.add.at(gone, hit, 1)
            np.add.at(gone, hit + window, -1)
            kept = np.cumsum(gone[:-1]) == 0
            words = np.diff(bounds)
            left = np.concatenate(([0], np.cumsum(kept)))[bounds]
            n_words.append(words)
            n_removed.append(words - np.diff(left))
            texts += _join_words(data, starts[kept], ends[kept], left)
        numbers = [np.concatenate(c) if c else np.empty(0, np.int64) for c in (n_words, n_removed)]
        return pa.table(
            [
                table.column("doc_id"),
                pa.array(numbers[0], pa.int64()),
                pa.array(numbers[1], pa.int64()),
                pa.array(texts, pa.string()),
            ],
            names=["doc_id", "n_words", "n_removed", "kept_text"],
        )

    return (
        chunked.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(remove, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")
    )


def _least_doc(held: list[tuple], told: Told) -> list[np.ndarray]:
    """Per slice and window the smallest id that has the window: in this chunk or as told."""
    sizes = [len(h[5]) for h in held]
    doc, high, low = (np.concatenate([h[i] for h in held] or [[]]) for i in (6, 7, 8))
    if not len(doc):
        return [np.empty(0, np.int64) for _ in held]
    order, group = groups(high, low)
    first = np.flatnonzero(np.diff(group, prepend=-1))
    least = np.empty(len(doc), np.int64)
    least[order] = np.minimum.reduceat(doc[order], first)[group]
    least = np.minimum(least, told.find(high, low, NO_DOC))
    return np.split(least, np.cumsum(sizes)[:-1])


def _join_words(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray
) -> list[bytes]:
    """Each row's words joined by one space; `bounds` are the rows' bounds in the words."""
    lengths = ends - starts + 1
    padded = np.append(data, np.uint8(0x20))
    flat = padded[np.minimum(K.ragged(starts, lengths), len(data))]
    edges = np.concatenate(([0], np.cumsum(lengths)))
    flat[edges[1:] - 1] = 0x20
    whole = flat.tobytes()
    edges = edges[bounds]
    return [whole[a : max(a, b - 1)].decode() for a, b in zip(edges[:-1], edges[1:], strict=True)]


def dedup_digests(docs: DataFrame) -> DataFrame:
    return repeated_words(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )
