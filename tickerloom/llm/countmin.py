"""A count-min sketch of hashes in texts, kept as which cells count two or more."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from tickerloom.llm import kernel as K

#: Cells of a sketch row, at most: the merged sketch has two rows of one bit a cell, 2 x 8 MB.
#: More values than cells only make the estimates larger, and so the work of a second pass.
MAX_CELLS_LOG2 = 26
SLICE_LOG2 = 18


def _cells(values: np.ndarray, log2: int) -> list[np.ndarray]:
    """The cell of each value in the two rows of the sketch."""
    other = values * np.uint64(0xD6E8FEB86659FD93)
    other ^= other >> np.uint64(32)
    other = other * np.uint64(0xCA5A826395121157)
    return [(x >> np.uint64(64 - log2)).astype(np.int64) for x in (values, other)]


def of_texts(
    values: Callable[[np.ndarray, np.ndarray], np.ndarray],
) -> Callable[[pa.RecordBatch], Iterator[np.ndarray]]:
    """``values(bytes, offsets)`` over the texts of a batch, slice by slice."""
    return lambda batch: (values(d, o) for _, _, d, o in K.text_slices(batch.column("text")))


def repeated_cells(
    df: DataFrame, values: Callable[[pa.RecordBatch], Iterator[np.ndarray]], log2: int
) -> list[np.ndarray]:
    """Per sketch row one bit a cell: whether the merged count is two or more.

    ``values(batch)`` gives the hashes of some rows. A task sends, per slice of cells, its nonzero cells and which of them it counted twice; a slice is merged in one
    task. Only the bits reach the driver, 16 MB at most.
    """
    width = min(SLICE_LOG2, log2)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[list[np.ndarray]] = [[], []]

        def rows() -> pa.RecordBatch:
            out: list[list] = [[], [], [], []]
            for r in (0, 1):
                cells, count = np.unique(
                    np.concatenate(seen[r] or [np.empty(0, np.int64)]), return_counts=True
                )
                edges = np.searchsorted(cells >> width, np.arange((1 << (log2 - width)) + 1))
                for s in np.flatnonzero(edges[:-1] < edges[1:]):
                    part = slice(edges[s], edges[s + 1])
                    inside = (cells[part] & ((1 << width) - 1)).astype(np.uint32)
                    out[0].append(r)
                    out[1].append(int(s))
                    out[2].append(inside.tobytes())
                    out[3].append(np.packbits(count[part] > 1).tobytes())
                seen[r].clear()
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
            return pa.record_batch(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                names=["row", "slice", "cells", "twice"],
            )

        held = 0
        for batch in batches:
            for found in values(batch):
                for r, cells in enumerate(_cells(found, log2)):
                    seen[r].append(cells)
                held += len(found)
                if held > 2_000_000:
                    held = 0
                    yield rows()
        yield rows()

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        count = np.zeros(1 << width, np.uint8)
        for cells, twice in zip(frame["cells"], frame["twice"], strict=True):
            at = np.frombuffer(cells, np.uint32)
            add = 1 + np.unpackbits(np.frombuffer(twice, np.uint8), count=len(at))
            count[at] = np.minimum(count[at] + add, 2)
        bits = np.packbits(count > 1).tobytes()
        return pd.DataFrame([(frame["row"].iloc[0], frame["slice"].iloc[0], bits)])

    parts = (
        df.mapInArrow(partial, "row int, slice int, cells binary, twice binary")
        .groupBy("row", "slice")
        .applyInPandas(merge, "row int, slice int, bits binary")
    )
    merged = [np.zeros(1 << max(0, log2 - 3), np.uint8) for _ in (0, 1)]
    size = 1 << max(0, width - 3)
    for row in parts.toLocalIterator():
        merged[row[0]][row[1] * size : (row[1] + 1) * size] = np.frombuffer(row[2], np.uint8)
    return merged


def estimated_repeated(values: np.ndarray, bits: list[np.ndarray], log2: int) -> np.ndarray:
    """Where the least of the two rows' counts is two or more."""
    out = np.ones(len(values), bool)
    for cells, row in zip(_cells(values, log2), bits, strict=True):
        out &= (row[cells >> 3] >> (7 - (cells & 7)) & 1).astype(bool)
    return out
