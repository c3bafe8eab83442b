"""Operator 2, benchmark decontamination: an FM-index per shard of training text.

The alphabet of a shard's index is the benchmark's vocabulary. A test phrase lies within
a run of words whose neighbours also stand side by side in the benchmark, so a shard
indexes those runs, with a separator between them; no other text can hold a phrase.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm import kernel as K

WINDOW = 13
SAMPLE = 8
#: Benchmark text of one pass: what is broadcast stays below this size, more is done in passes.
BLOCK_BYTES = 16 << 20

#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing: digits, a-z and all of non-ASCII.
WORD_BYTE = np.zeros(256, dtype=bool)
WORD_BYTE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class WaveletTree:
    """Ranks of symbols in a sequence, by one bit vector a level (a wavelet matrix)."""

    def __init__(self, values: np.ndarray, bits: int) -> None:
        self._bits = bits
        self._ones: list[np.ndarray] = []
        self._zeros: list[int] = []
        for level in range(bits - 1, -1, -1):
            bit = (values >> level) & 1
            self._ones.append(np.concatenate(([0], np.cumsum(bit))).astype(np.int32))
            self._zeros.append(len(values) - int(self._ones[-1][-1]))
            values = np.concatenate((values[bit == 0], values[bit == 1]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its position."""
        start = np.zeros_like(at)
        for i, (ones, zeros) in enumerate(zip(self._ones, self._zeros, strict=True)):
            one = (symbol >> (self._bits - 1 - i)) & 1 == 1
            start = np.where(one, zeros + ones[start], start - ones[start])
            at = np.where(one, zeros + ones[at], at - ones[at])
        return at - start

    def symbol(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros_like(at)
        for ones, zeros in zip(self._ones, self._zeros, strict=True):
            one = ones[at + 1] - ones[at]
            out = out * 2 + one
            at = np.where(one == 1, zeros + ones[at], at - ones[at])
        return out


class FmIndex:
    """Counts and locates phrases in a sequence of symbols from 1; 0 separates its runs."""

    def __init__(self, text: np.ndarray, symbols: int) -> None:
        n = len(text)
        self._suffix = _suffix_array(text)
        previous = np.where(self._suffix > 0, text[self._suffix - 1], 0)
        self._tree = WaveletTree(previous, max(1, int(symbols).bit_length()))
        self._before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols + 1))))
        run_start = np.ones(n, bool)
        run_start[1:] = text[:-1] == 0
        keep = run_start | (np.arange(n) % SAMPLE == 0)
        self._sampled = keep[self._suffix]
        self._samples = self._suffix[self._sampled]
        self._sample_rank = np.concatenate(([0], np.cumsum(self._sampled)))
        del self._suffix

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of the rows of `phrases`, by backward search over all at once."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), len(self._sampled), np.int64)
        alive = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[alive, column]
            base = self._before[symbol]
            low[alive] = base + self._tree.rank(symbol, low[alive])
            high[alive] = base + self._tree.rank(symbol, high[alive])
            alive = alive[low[alive] < high[alive]]
        found = np.zeros(len(phrases), bool)
        found[alive] = True
        return np.where(found, low, 0), np.where(found, high, 0)

    def locate(self, at: np.ndarray) -> np.ndarray:
        """Text positions of suffix ranks: walk back to a sampled position."""
        out = np.zeros(len(at), np.int64)
        open_, steps = np.arange(len(at)), 0
        while len(open_):
            done = self._sampled[at]
            out[open_[done]] = self._samples[self._sample_rank[at[done]]] + steps
            open_, at = open_[~done], at[~done]
            symbol = self._tree.symbol(at)
            at = self._before[symbol] + self._tree.rank(symbol, at)
            steps += 1
        return out


def _suffix_array(text: np.ndarray) -> np.ndarray:
    """By prefix doubling; each separator counts as a symbol of its own."""
    n = len(text)
    separators = text == 0
    rank = text.astype(np.int64) + n
    rank[separators] = np.arange(n)[separators]
    step = 1
    _, rank = np.unique(rank, return_inverse=True)
    while True:
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        step *= 2


@dataclass
class Phrases:
    """The test phrases of some benchmark items, as broadcast to the tasks."""

    vocabulary: np.ndarray
    pairs: np.ndarray
    #: Per length: phrases as rows of symbols, and per phrase its items.
    by_length: dict[int, tuple[np.ndarray, list[np.ndarray]]]
    items: list[str]

    @classmethod
    def of(cls, items: list[tuple[int, str]], window: int) -> Phrases:
        column = pa.array([t or "" for _, t in items], pa.string())
        data, offsets = K.text_arrays(column)
        data = K.LOWER[data]
        starts, ends, bounds = K.words(data, offsets, WORD_BYTE)
        vocabulary, symbol = np.unique(K.word_hashes(data, starts, ends), return_inverse=True)
        symbol = symbol.astype(np.int64) + 1
        base = len(vocabulary) + 1
        inner = np.ones(len(symbol), bool)
        inner[bounds[1:-1][bounds[1:-1] < len(symbol)]] = False
        pairs = np.unique(symbol[:-1][inner[1:]] * base + symbol[1:][inner[1:]])
        found: dict[int, dict[tuple, set[int]]] = {}
        for k in range(len(items)):
            words = symbol[bounds[k] : bounds[k + 1]]
            size = min(window, len(words))
            for at in range(len(words) - size + 1 if size else 0):
                found.setdefault(size, {}).setdefault(tuple(words[at : at + size]), set()).add(k)
        by_length = {
            size: (
                np.array(list(known), np.int64),
                [np.array(sorted(v)) for v in known.values()],
            )
            for size, known in found.items()
        }
        return cls(vocabulary, pairs, by_length, [str(i) for i, _ in items])


def _hits(phrases: Phrases, data: np.ndarray, offsets: np.ndarray) -> tuple:
    """Words per row, and the covered spans as ``(row, first word, length, items)``."""
    starts, ends, bounds = K.words(data, offsets, WORD_BYTE)
    n_words = np.diff(bounds)
    spans: list[tuple[np.ndarray, int, list[np.ndarray], np.ndarray]] = []
    if not phrases.by_length or not len(starts):
        return n_words, bounds, spans
    hashes = K.word_hashes(data, starts, ends)
    at = np.minimum(np.searchsorted(phrases.vocabulary, hashes), len(phrases.vocabulary) - 1)
    symbol = np.where(phrases.vocabulary[at] == hashes, at + 1, 0)
    joined = np.zeros(len(symbol), bool)
    both = np.flatnonzero((symbol[:-1] > 0) & (symbol[1:] > 0))
    if len(both) and len(phrases.pairs):
        pair = symbol[both] * (len(phrases.vocabulary) + 1) + symbol[both + 1]
        k = np.minimum(np.searchsorted(phrases.pairs, pair), len(phrases.pairs) - 1)
        joined[both[phrases.pairs[k] == pair]] = True
    inner = bounds[1:-1]
    joined[inner[(inner > 0)] - 1] = False
    first = np.flatnonzero(np.concatenate(([True], ~joined[:-1])))
    size = np.diff(np.append(first, len(symbol)))
    keep = (size >= min(phrases.by_length)) & (symbol[first] > 0)
    first, size = first[keep], size[keep]
    if not len(first):
        return n_words, bounds, spans
    source = K.ragged(first, size + 1)
    text = symbol[np.minimum(source, len(symbol) - 1)]
    text[np.cumsum(size + 1) - 1] = 0
    index = FmIndex(text, len(phrases.vocabulary))
    for length, (rows, owners) in phrases.by_length.items():
        low, high = index.search(rows)
        some = np.flatnonzero(high > low)
        if len(some):
            count = high[some] - low[some]
            places = source[index.locate(K.ragged(low[some], count))]
            spans.append((places, length, [owners[k] for k in some], np.repeat(np.arange(len(some)), count)))
    return n_words, bounds, spans


SCHEMA = "doc_id bigint, n_words bigint, hits array<struct<first:bigint,end:bigint>>, items array<string>"


def _marked(docs: DataFrame, phrases: Phrases, carry: bool) -> DataFrame:
    """Per row the merged spans of hit words, counted in words, and the items found."""
    shared = docs.sparkSession.sparkContext.broadcast(phrases)
    span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for first, last, data, offsets in K.text_slices(batch.column("text")):
                n_words, bounds, spans = _hits(known, K.LOWER[data], offsets)
                delta = np.zeros(int(bounds[-1]) + 1, np.int64)
                items: dict[int, set[int]] = {}
                for places, length, owners, which in spans:
                    np.add.at(delta, places, 1)
                    np.add.at(delta, places + length, -1)
                    rows = np.searchsorted(bounds, places, side="right") - 1
                    for row, k in set(zip(rows.tolist(), which.tolist(), strict=True)):
                        items.setdefault(row, set()).update(owners[k].tolist())
                hit = np.cumsum(delta[:-1]) > 0
                edge = np.diff(hit.astype(np.int8), prepend=0, append=0)
                begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                merged: dict[int, list] = {}
                for a, b in zip(begin.tolist(), end.tolist(), strict=True):
                    while a < b:
                        row = int(np.searchsorted(bounds, a, side="right")) - 1
                        stop = min(b, int(bounds[row + 1]))
                        merged.setdefault(row, []).append(
                            {"first": a - int(bounds[row]), "end": stop - int(bounds[row])}
                        )
                        a = stop
                count = last - first
                part = batch.slice(first, count)
                columns = part.columns if carry else [part.column("doc_id")]
                names = part.schema.names if carry else ["doc_id"]
                yield pa.record_batch(
                    [
                        *columns,
                        pa.array(n_words, pa.int64()),
                        pa.array([merged.get(r, []) for r in range(count)], span),
                        pa.array(
                            [[known.items[i] for i in sorted(items.get(r, ()))] for r in range(count)],
                            pa.list_(pa.string()),
                        ),
                    ],
                    names=[*names, "_n_words" if carry else "n_words", "_hits" if carry else "hits", "_items" if carry else "items"],
                )

    if not carry:
        return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, SCHEMA)
    schema = docs.withColumns(
        {
            "_n_words": F.lit(0).cast("bigint"),
            "_hits": F.array().cast("array<struct<first:bigint,end:bigint>>"),
            "_items": F.array().cast("array<string>"),
        }
    ).schema
    return docs.mapInArrow(run, schema)


def _blocks(benchmark: DataFrame, window: int) -> list[Phrases]:
    """Phrases in blocks of bounded text: each block is one pass over the documents."""
    rows = benchmark.select(F.col("item_id").cast("bigint"), "text").where("text IS NOT NULL")
    size = K.total_bytes(rows)
    n = max(1, -(-size // BLOCK_BYTES))
    if n == 1:
        return [Phrases.of([tuple(r) for r in rows.toLocalIterator()], window)]
    parts = rows.withColumn("part", K.chunk_of(n, "item_id", "text"))
    return [
        Phrases.of([tuple(r)[:2] for r in parts.where(F.col("part") == k).toLocalIterator()], window)
        for k in range(n)
    ]


def mark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` with ``_n_words``, ``_hits`` (spans of hit words) and ``_items`` (ids found).

    Null and empty texts have no words; items without words have no phrases; an item
    shorter than the window is one phrase. Repeated items and rows count each. Items are
    read in blocks of 16 MB, each a pass over the documents with the spans merged after.
    """
    blocks = _blocks(benchmark, window)
    out = _marked(docs, blocks[0], True)
    for block in blocks[1:]:
        names = [c for c in out.columns if c not in ("_n_words", "_hits", "_items")]
        before = out.withColumnsRenamed({"_hits": "_hits0", "_items": "_items0"}).drop("_n_words")
        out = _marked(before, block, True).select(
            *names,
            "_n_words",
            F.array_sort(F.array_distinct(F.concat("_hits0", "_hits"))).alias("_hits"),
            F.array_distinct(F.concat("_items0", "_items")).alias("_items"),
        )
    return out


def n_hit(hits: str) -> F.Column:
    """Words covered by spans that are sorted by their start and may overlap."""
    seen = F.struct(F.lit(0).cast("bigint").alias("words"), F.lit(0).cast("bigint").alias("end"))
    return F.aggregate(
        hits,
        seen,
        lambda s, h: F.struct(
            (s["words"] + F.greatest(h["end"] - F.greatest(h["first"], s["end"]), F.lit(0))).alias("words"),
            F.greatest(s["end"], h["end"]).alias("end"),
        ),
        lambda s: s["words"],
    )


def judged(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Counts and verdict per document; contaminated from a twentieth of hit words on."""
    rows = mark(docs.select(F.col("doc_id").cast("bigint"), "text"), benchmark, window)
    items = F.array_sort(F.array_distinct("_items"))
    return rows.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        n_hit("_hits").alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, with their columns as they were."""
    # Columns go by number meanwhile, so that none can be taken for one of the marks.
    numbered = ["text" if c == "text" else f"c{k}" for k, c in enumerate(docs.columns)]
    rows = mark(docs.toDF(*numbered), benchmark, window)
    hit = n_hit("_hits")
    clean = rows.where(~((hit > 0) & (20 * hit >= F.col("_n_words"))))
    return clean.select(*numbered).toDF(*docs.columns)
