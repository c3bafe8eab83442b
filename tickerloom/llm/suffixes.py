"""Operator 10, suffix-array dedup: prefix doubling over sampled text positions.

Ranking every byte would move the corpus many times over. A site is the position of the
smallest 16-byte hash in a stretch of 160 bytes; which site a 400-byte string has
follows from its bytes alone, so equal strings have equal sites, at equal distances.

Only sites are ranked. Strings of a site that are all repeated together are done first.
The others are ranked by 64 bytes, then in rounds by pairs of ranks: their own and that
of the site 1, 2 sites on. A rank is the name of a string, 64 bits of hash, as only
equality matters; Spark brings equal pairs together, and a site leaves when its rank is
unique or when the next pair would reach past what all its strings hold. The strings of
the sites that stay are compared one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm import kernel as K
from tickerloom.llm.countmin import MAX_CELLS_LOG2, estimated_repeated, of_texts, repeated_cells
from tickerloom.llm.exchange import ASK, Told, bucket_count, exchange, groups, pack
from tickerloom.llm.stage import staged

LENGTH = 400
GRAM = 16
STRETCH = 160
#: Bytes of the first rank.
FIRST = 64
ROUNDS = 2
FAR = 1 << 30
FILTER_LOG2 = 23
_LOW = np.uint64(0xFFFFFFFF)
_HIGH = ~_LOW


@dataclass
class Sites:
    """Sites of some texts: row, position, the first and last start of its strings, first rank."""

    row: np.ndarray
    at: np.ndarray
    low: np.ndarray
    high: np.ndarray
    first: np.ndarray
    values: K.Ranges


def sites_of(data: np.ndarray, offsets: np.ndarray) -> Sites:
    ranges = K.Ranges(K.BYTE_VALUE[0][data])
    grams = ranges.fixed(GRAM)
    order = (grams & _HIGH) | np.arange(len(grams), dtype=np.uint64)
    per_row = np.maximum(np.diff(offsets) - (STRETCH + GRAM - 1) + 1, 0)
    start = K.ragged(offsets[:-1], per_row)
    row = np.repeat(np.arange(len(per_row)), per_row)
    if not len(start):
        none = np.empty(0, np.int64)
        return Sites(none, none, none, none, np.empty(0, np.uint64), ranges)
    at = (K.sliding_min(order, STRETCH)[start] & _LOW).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    row, at, low, high = row[first], at[first], start[first], start[last]
    keep = at + FIRST <= offsets[row + 1]
    row, at, low, high = row[keep], at[keep], low[keep], high[keep]
    return Sites(row, at, low, high, ranges.hash(at, at + FIRST), ranges)


def names(s: Sites, core: int) -> list[np.ndarray]:
    """Per round the rank of every site, 0 where it would reach past `core` bytes.

    Which site comes next after one at x follows from the bytes up to x + STRETCH + GRAM,
    so a pair reaches that far even where the strings it names end before.
    """
    out, reach = [s.first], np.full(len(s.at), FIRST)
    count = len(s.at)
    for k in range(ROUNDS):
        to = np.minimum(np.arange(count) + (1 << k), max(0, count - 1))
        gap = np.where((s.row[to] == s.row) & (to > np.arange(count)), s.at[to] - s.at, FAR)
        longer = np.minimum(np.maximum(gap + reach[to], STRETCH + GRAM), FAR)
        pair = K._mix(out[-1] * np.uint64(3) + K._mix(out[-1][to] + gap.astype(np.uint64)))
        out.append(np.where(longer <= core, pair | np.uint64(1), np.uint64(0)))
        reach = np.where(longer <= core, longer, FAR)
    return out


SITES = "text_hash bigint, low int, high int, whole bigint, repeated boolean, " + ", ".join(
    f"rank{k} bigint" for k in range(ROUNDS + 1)
)


def _wholes(s: Sites, offsets: np.ndarray, length: int, core: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sites with strings in their row, the last start of these, and a hash of all of them."""
    end = offsets[s.row + 1]
    high = np.minimum(s.high, end - length)
    keep = np.flatnonzero((s.at + core <= end) & (s.low <= high))
    return keep, high[keep], s.values.hash(s.low[keep], high[keep] + length)


def _sites(rows: DataFrame, length: int, first_bits, whole_bits, log2: int) -> DataFrame:
    """The sites whose first 64 bytes are estimated to be repeated."""
    core = length - STRETCH + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text_hash = batch.column("text_hash").to_numpy()
            for first, _, data, offsets in K.text_slices(batch.column("text")):
                s = sites_of(data, offsets)
                keep, high, whole = _wholes(s, offsets, length, core)
                likely = estimated_repeated(s.first[keep], first_bits.value, log2)
                keep, high, whole = keep[likely], high[likely], whole[likely]
                row = s.row[keep]
                yield pa.record_batch(
                    [
                        pa.array(text_hash[row + first]),
                        pa.array((s.low[keep] - offsets[row]).astype(np.int32)),
                        pa.array((high - offsets[row]).astype(np.int32)),
                        pa.array(whole.astype(np.int64)),
                        pa.array(estimated_repeated(whole, whole_bits.value, log2)),
                        *[pa.array(n[keep].astype(np.int64)) for n in names(s, core)],
                    ],
                    names=[c.split()[0] for c in SITES.split(", ")],
                )

    return rows.mapInArrow(run, SITES)


def doubled(sites: DataFrame) -> DataFrame:
    """Of `sites` with a weight those whose strings may be repeated, with what names these.

    Each round keeps the sites whose rank has a weight of two or more together, and those
    that stopped before; the next one ranks them by the pair twice as long.
    """
    sites = sites.withColumn("name", F.lit(0).cast("bigint"))
    for k in range(ROUNDS + 1):
        rank = f"rank{k}"
        live = sites.where(F.col(rank) != 0)
        again = live.groupBy(rank).agg(F.sum("weight").alias("n")).where("n > 1").select(rank)
        kept = live.join(again, rank).withColumn("name", F.col(rank))
        sites = staged(kept.unionByName(sites.where(F.col(rank) == 0)).drop(rank))
    return sites


def _spans_by_text(spans: DataFrame) -> DataFrame:
    """Packed ``low, high`` pairs per text."""
    return spans.groupBy("text_hash").agg(
        F.sort_array(F.collect_set(F.struct("low", "high"))).alias("spans")
    )


def _bit_filter(keys: DataFrame) -> np.ndarray:
    """Bits of the text hashes in `keys`, of fixed size."""
    size = 1 << FILTER_LOG2
    cell = F.pmod(F.col("text_hash"), F.lit(size)).cast("int")
    bits = np.zeros(size, bool)
    packed = keys.select(cell.alias("c")).groupBy((F.col("c") / 1024).cast("int").alias("w"))
    for _, cells in packed.agg(F.collect_set("c").alias("c")).toLocalIterator():
        bits[cells] = True
    return np.packbits(bits)


def _texts(rows: DataFrame, keys: DataFrame, inside: bool, once: bool = False) -> DataFrame:
    """The rows whose text may be in `keys`, or all others; with `once` one of each a task."""
    shared = rows.sparkSession.sparkContext.broadcast(_bit_filter(keys))
    at = rows.columns.index("text_hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            hashes = batch.column(at).to_numpy()
            cells = hashes % (1 << FILTER_LOG2)
            hit = (shared.value[cells >> 3] >> (7 - (cells & 7)) & 1).astype(bool) == inside
            if once:
                for k in np.flatnonzero(hit):
                    hit[k] = hashes[k] not in seen
                    seen.add(hashes[k])
            yield batch.filter(pa.array(hit))

    return rows.mapInArrow(run, rows.schema)


#: Text of one chunk of strings; each of them takes 29 bytes in the arrays of its chunk.
CHUNK_BYTES = 3 << 19
#: Types of a string's key beside its first 64 bits, and of its count, two at most.
_LOW_TYPE, _COUNT_TYPE = np.uint32, np.uint8


def _keys_of(texts: pa.Table, sites: pa.Table, length: int) -> tuple[np.ndarray, ...]:
    """Text, start, weight and key of every string of the sites in one chunk."""
    hashes = texts.column("text_hash").to_numpy()
    _, one = np.unique(hashes, return_index=True)
    text_hash = sites.column("text_hash").to_numpy()
    order = np.argsort(text_hash, kind="stable")
    columns = [sites.column(c).to_numpy()[order].astype(np.int64) for c in ("low", "high", "weight")]
    edges = np.searchsorted(text_hash[order], hashes[one]), np.searchsorted(
        text_hash[order], hashes[one], side="right"
    )
    out: list[list[np.ndarray]] = [[], [], [], [], []]
    column = texts.column("text").take(pa.array(one))
    for first, last, data, offsets in K.text_slices(column):
        begin, count = edges[0][first:last], (edges[1] - edges[0])[first:last]
        at = K.ragged(begin, count)
        of = np.repeat(np.arange(last - first), count)
        low, high, weight = (c[at] for c in columns)
        n = high - low + 1
        p = K.ragged(low + offsets[of], n)
        parts = (
            np.repeat(hashes[one[first:last]][of], n),
            K.ragged(low, n),
            np.repeat(weight, n),
            K.Ranges(K.BYTE_VALUE[0][data]).hash(p, p + length),
            K.Ranges(K.BYTE_VALUE[1][data], 1).hash(p, p + length).astype(_LOW_TYPE),
        )
        for held, part in zip(out, parts, strict=True):
            held.append(part)
    kinds = (np.int64, np.int64, np.int64, np.uint64, _LOW_TYPE)
    return tuple(np.concatenate(c) if c else np.empty(0, k) for c, k in zip(out, kinds, strict=True))


def _single_strings(rows: DataFrame, work: DataFrame, length: int, size: int) -> DataFrame:
    """``(text_hash, low, high)`` of the strings in `work` that occur twice.

    `work` has one site for each distinct whole; `weight` is 2 where that whole itself
    occurs more than once.
    """
    chunk = K.chunk_of(max(8, -(-size // CHUNK_BYTES)), "text_hash")
    strings = work.agg(F.sum(F.col("high") - F.col("low") + 1)).first()[0] or 0
    buckets = bucket_count(4 * strings)  # a quarter of the usual memory a bucket
    texts = _texts(rows, work.select("text_hash").distinct(), True, once=True).withColumn("chunk", chunk)
    sites = work.withColumn("chunk", chunk)

    def ask(texts: pa.Table, sites: pa.Table) -> pa.Table:
        _, _, weight, high, low = _keys_of(texts, sites, length)
        rows = []
        if len(high):
            order, group = groups(high, low)
            first = np.flatnonzero(np.diff(group, prepend=-1))
            at = order[first]
            total = np.minimum(np.add.reduceat(weight[order], first), 2).astype(_COUNT_TYPE)
            rows = pack(texts.column("chunk")[0].as_py(), buckets, high[at], low[at], total)
        columns = list(zip(*rows, strict=True)) if rows else [[], [], [], [], []]
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.table(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
            names=["bucket", "chunk", "high", "low", "known"],
        )

    asked = texts.groupBy("chunk").cogroup(sites.groupBy("chunk")).applyInArrow(ask, ASK)
    answers = exchange(
        asked, np.add, lambda known, joint: joint > 1, _LOW_TYPE, _COUNT_TYPE
    )
    none = {c: F.lit(None) for c in ("high_key", "low_key", "value")}
    told = sites.select("chunk", "text_hash", "low", "high", "weight").withColumns(
        {c: v.cast("binary") for c, v in none.items()}
    )
    told = told.unionByName(
        answers.select(
            "chunk", F.col("high").alias("high_key"), F.col("low").alias("low_key"), "value"
        ),
        allowMissingColumns=True,
    )

    def spans(texts: pa.Table, told: pa.Table) -> pa.Table:
        is_site = pc.is_null(told.column("value"))
        answered = told.filter(pc.invert(is_site))
        packed = (b"".join(answered.column(c).to_pylist()) for c in ("high_key", "low_key", "value"))
        known = Told(*packed, _LOW_TYPE, _COUNT_TYPE)
        text, start, _, high, low = _keys_of(texts, told.filter(is_site), length)
        hit = known.find(high, low, 0) > 1
        text, start = text[hit], start[hit]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(text)) - 1 if len(text) else first
        return pa.table(
            [
                pa.array(text[first]),
                pa.array(start[first].astype(np.int32)),
                pa.array(start[last].astype(np.int32)),
            ],
            names=["text_hash", "low", "high"],
        )

    return (
        texts.groupBy("chunk")
        .cogroup(told.groupBy("chunk"))
        .applyInArrow(spans, "text_hash bigint, low int, high int")
    )


def repeated_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row: id, bytes, bytes removed, number of removed runs, and the bytes that stay.

    A byte goes when a string of `length` bytes over it also starts elsewhere, in any row,
    the same one included. Null text has no bytes; texts shorter than `length` stay. Null
    ids and repeated rows are rows like others: equal long rows remove each other whole.
    """
    if length < STRETCH + FIRST + GRAM:
        raise ValueError(f"length must be at least {STRETCH + FIRST + GRAM}")
    K.modest_batches(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("bigint"), "text").withColumn("text_hash", F.xxhash64("text"))
    rows = base.select("text", "text_hash")
    size = K.total_bytes(base)
    log2 = min(MAX_CELLS_LOG2, max(12, int(size).bit_length() - 3))
    core = length - STRETCH + 1
    share = docs.sparkSession.sparkContext.broadcast

    def wholes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return _wholes(sites_of(data, offsets), offsets, length, core)[2]

    first_bits = share(repeated_cells(rows, of_texts(lambda d, o: sites_of(d, o).first), log2))
    whole_bits = share(repeated_cells(rows, of_texts(wholes), log2))
    sites = staged(_sites(rows, length, first_bits, whole_bits, log2))

    likely = sites.where("repeated")
    counts = likely.groupBy("whole").agg(F.count(F.lit(1)).alias("n"), F.min("text_hash").alias("one"))
    counts = staged(counts.where("n > 1"))
    flagged = staged(likely.drop("repeated").join(counts.select("whole", "one"), "whole", "left"))
    sure = flagged.where("one IS NOT NULL").select("text_hash", "low", "high")
    alone = flagged.where("one IS NULL").drop("one").unionByName(sites.where("NOT repeated").drop("repeated"))
    alone = alone.withColumn("weight", F.lit(1))
    # of a repeated whole one site stands for all, and only where a lone one may equal it
    one_each = (
        flagged.where("one = text_hash")
        .drop("one")
        .join(alone.select("rank0").distinct(), "rank0", "left_semi")
        .dropDuplicates(["whole"])
        .withColumn("weight", F.lit(2))
    )
    named = doubled(alone.unionByName(one_each).drop("whole"))
    mixed = named.groupBy("name").agg(F.min("weight").alias("least")).where("least = 1").select("name")
    work = staged(named.join(mixed, "name").select("text_hash", "low", "high", "weight"))
    single = _single_strings(rows, work, length, size)
    removed = staged(_spans_by_text(sure.unionByName(single)))
    untouched = _texts(base, removed, False).select(
        "doc_id", "text", F.lit(None).cast(removed.schema["spans"].dataType).alias("spans")
    )
    touched = _texts(base, removed, True).join(removed, "text_hash", "left")
    marked = untouched.unionByName(touched.select("doc_id", "text", "spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                data = (text.as_py() or "").encode()
                parts, at, gone, runs, end = [], 0, 0, 0, -1
                for span in spans.as_py() or ():
                    low, high = span["low"], span["high"] + length
                    if low > end:
                        runs += 1
                        parts.append(data[at:low])
                        gone += high - low
                    else:
                        gone += max(0, high - end)
                    at = end = max(end, high)
                parts.append(data[at:])
                for column, value in zip(out, (len(data), gone, runs, b"".join(parts)), strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.record_batch(
                [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(out, kinds, strict=True)]],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return marked.mapInArrow(
        cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    )


def dedup_digests(docs: DataFrame) -> DataFrame:
    return repeated_bytes(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
