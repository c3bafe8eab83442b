"""Operator 13, SimHash near-duplicates by anchor-point covering.

Anchors are the words of a covering code: every word of a block of bits is within the
code's covering radius R of an anchor, its home. If two words differ in t bits or fewer,
the home of one is within R + t of the other. So each fingerprint goes to its home and to
every anchor within R + t, and an anchor compares those at home with all that came.

A block is 23 bits under the binary Golay code (R = 3, every word has exactly one home)
and further bits under the trivial code (R = 0). A whole fingerprint has 64 bits; two that
differ in 4 at most differ in at most t_i bits of some block i, as the t_i + 1 sum to
more than 4 over the blocks. A layout names the blocks and their t_i.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm import kernel as K
from tickerloom.llm.similar import components
from tickerloom.llm.stage import staged

WIDTH = 4
SEED = 42
#: Fingerprints link at this many differing bits or fewer.
DIFFER = 4
GOLAY_BITS = 23
GOLAY_RADIUS = 3
#: Generator of the binary Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GOLAY_POLYNOMIAL = 0b110001110101
#: Fingerprints of one anchor that a task holds; an anchor with more is cut into slices.
SLICE = 4096
#: Cells of the table of differences a task makes at a time.
TILE = 1 << 18
#: Parts by which rows of one fingerprint are spread.
SALTS = 1024
#: Shingles hashed at a time.
LOT = 1 << 16


@dataclass(frozen=True)
class Block:
    """Bits of a fingerprint from `shift` on: perhaps 23 under the Golay code, then `plain` ones."""

    shift: int
    golay: bool
    plain: int
    threshold: int

    @property
    def bits(self) -> int:
        return self.plain + (GOLAY_BITS if self.golay else 0)

    @cached_property
    def patterns(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Differences to the anchors within reach, by syndrome, and whether they lead home."""
        radius = GOLAY_RADIUS if self.golay else 0
        code = _weights(GOLAY_BITS if self.golay else 0, radius + self.threshold)
        plain = _weights(self.plain, self.threshold)
        shift = GOLAY_BITS if self.golay else 0
        words, costs = [], []
        for w, some in code.items():
            for p, others in plain.items():
                cost = max(0, w - radius) + p
                if cost <= self.threshold:
                    both = (others[:, None] << np.uint64(shift) | some).ravel()
                    words.append(both)
                    costs.append(np.full(len(both), cost))
        word, cost = np.concatenate(words), np.concatenate(costs)
        of = self.syndromes(word)
        order = np.lexsort((cost, of))
        edges = np.searchsorted(of[order], np.arange(2 if not self.golay else 2049))
        return word[order], cost[order] == 0, edges

    def syndromes(self, words: np.ndarray) -> np.ndarray:
        if not self.golay:
            return np.zeros(len(words), np.int64)
        low, high = _SYNDROMES
        part = (words & np.uint64((1 << GOLAY_BITS) - 1)).astype(np.int64)
        return low[part & 4095] ^ high[part >> 12]

    def anchors(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(row, anchor, home)`` of every anchor within reach of each fingerprint."""
        words = prints >> np.uint64(self.shift) & np.uint64((1 << self.bits) - 1)
        pattern, home, edges = self.patterns
        of = self.syndromes(words)
        count = edges[of + 1] - edges[of]
        rows = np.repeat(np.arange(len(words)), count)
        at = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count) + edges[of][rows]
        return rows, words[rows] ^ pattern[at], home[at]


def _weights(bits: int, most: int) -> dict[int, np.ndarray]:
    """Words of `bits` bits by their number of ones, up to `most`."""
    return {
        w: np.array([sum(1 << b for b in ones) for ones in combinations(range(bits), w)], np.uint64)
        for w in range(min(bits, most) + 1)
    }


def _remainder(word: int) -> int:
    for bit in range(GOLAY_BITS - 1, 10, -1):
        if word >> bit & 1:
            word ^= GOLAY_POLYNOMIAL << (bit - 11)
    return word


_SYNDROMES = (
    np.array([_remainder(w) for w in range(4096)]),
    np.array([_remainder(w << 12) for w in range(2048)]),
)

#: About 12 anchors a fingerprint; one pair in 400 is compared.
NARROW = (Block(0, True, 0, 1), Block(23, True, 0, 1), Block(46, False, 18, 0))
#: About 120 anchors a fingerprint; one pair in 17,000 is compared.
WIDE = (Block(0, True, 9, 2), Block(32, True, 9, 1))
#: Fingerprints from which fewer comparisons are worth more copies.
WIDE_FROM = 1 << 26


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(doc_id, print)``: bit b is set if it is in over half of the shingles' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), width) for t in batch.column("text")], np.uint64)
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(prints.view(np.int64))], names=["doc_id", "print"]
            )

    K.modest_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, print bigint")


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """The fingerprint of a whole text; zero without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    shingles = max(1, len(words) - width + 1)
    starts, ends = starts[:shingles].tolist(), ends[len(words) - shingles :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for k in range(0, shingles, LOT):
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts[k : k + LOT], ends[k : k + LOT], strict=True)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > shingles, bitorder="little").view("<u8")[0])


def covered(prints: DataFrame, layout: tuple[Block, ...]) -> DataFrame:
    """Every distinct `print` at every anchor in its reach: ``(block, anchor, visit, print)``.

    `visit` is 0 at home, and every fingerprint at home is among the visitors (1) too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = batch.column("print").to_numpy().view(np.uint64)
            for number, block in enumerate(layout):
                rows, anchors, home = block.anchors(of)
                rows, anchors = (np.concatenate((x, x[home])) for x in (rows, anchors))
                visit = np.ones(len(rows), np.int8)
                visit[len(home) :] = 0
                yield pa.record_batch(
                    [
                        pa.array(np.full(len(rows), number, np.int32)),
                        pa.array(anchors.view(np.int64)),
                        pa.array(visit),
                        pa.array(of[rows].view(np.int64)),
                    ],
                    names=["block", "anchor", "visit", "print"],
                )

    return prints.select("print").mapInArrow(run, "block int, anchor bigint, visit tinyint, print bigint")


class Anchor:
    """Those at home at one anchor (or a slice of them), and what joins them."""

    def __init__(self, key: tuple, differ: int) -> None:
        self.key, self.differ = key, differ
        self.home = np.zeros(0, np.uint64)
        self.label = np.zeros(0, np.int64)

    def settle(self, prints: np.ndarray) -> None:
        self.home = np.concatenate((self.home, prints))
        self.label = np.arange(len(self.home))

    def visited(self, prints: np.ndarray) -> list[np.ndarray]:
        """Pairs that connect all that link here: one a visitor, and one less than those at home."""
        out = []
        if not len(self.home):
            return out
        step = max(1, TILE // len(self.home))
        for k in range(0, len(prints), step):
            lot = prints[k : k + step]
            apart = np.bitwise_count(lot[:, None] ^ self.home)
            row, col = np.nonzero((apart <= self.differ) & (apart > 0))
            if not len(row):
                continue
            first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            out.append(np.stack((lot[row[first]], self.home[col[first]])))
            out.append(self._joined(row, col, first))
        return out

    def _joined(self, row: np.ndarray, col: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Give all homes of one visitor one label; the pairs that say so."""
        visitor = np.cumsum(np.concatenate(([0], (row[1:] != row[:-1]).astype(np.int64))))
        root = np.arange(len(self.home))
        while True:
            now = root[self.label[col]]
            least = np.minimum.reduceat(now, first)[visitor]
            if (now == least).all():
                break
            np.minimum.at(root, now, least)
            while (root[root] != root).any():
                root = root[root]
        gone = np.flatnonzero(root != np.arange(len(root)))
        self.label = root[self.label]
        return np.stack((self.home[gone], self.home[root[gone]]))


def linked_prints(prints: DataFrame, layout: tuple[Block, ...], differ: int = DIFFER) -> DataFrame:
    """Pairs ``(a, b)`` of distinct fingerprints whose components are those of all links.

    An anchor with more than `SLICE` at home is cut into slices, and its visitors go to
    all of them, so one passage in a third of all rows does not fill a task.
    """
    copies = staged(covered(prints, layout))
    full = (
        copies.where("visit = 0")
        .groupBy("block", "anchor")
        .count()
        .where(F.col("count") > SLICE)
        .select("block", "anchor", F.ceil(F.col("count") / SLICE).cast("int").alias("slices"))
    )
    full = staged(full)
    if full.isEmpty():
        dealt = copies.withColumn("slice", F.lit(0))
    else:
        one = F.pmod(F.xxhash64("print"), "slices").cast("int")
        every = F.explode(F.when(F.col("visit") == 0, F.array(one)).otherwise(F.sequence(F.lit(0), F.col("slices") - 1)))
        dealt = (
            copies.join(full, ["block", "anchor"], "left")
            .withColumn("slices", F.coalesce("slices", F.lit(1)))
            .select("block", "anchor", "visit", "print", every.alias("slice"))
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor: Anchor | None = None
        for batch in batches:
            block, word, part, visit, of = (
                batch.column(c).to_numpy() for c in ("block", "anchor", "slice", "visit", "print")
            )
            of = of.view(np.uint64)
            new = (block[1:] != block[:-1]) | (word[1:] != word[:-1]) | (part[1:] != part[:-1])
            edges = [0, *(np.flatnonzero(new) + 1).tolist(), len(of)]
            found = []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a == b:
                    continue
                key = (block[a], word[a], part[a])
                if anchor is None or anchor.key != key:
                    anchor = Anchor(key, differ)
                homes = a + int(np.searchsorted(visit[a:b], 1))
                if homes > a:
                    anchor.settle(of[a:homes])
                # A lone home is its own only visitor.
                if b - homes > 1 or len(anchor.home) != 1 or homes == a:
                    found += anchor.visited(of[homes:b])
            if found:
                pairs = np.concatenate(found, axis=1).view(np.int64)
                yield pa.record_batch([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    keys = ["block", "anchor", "slice"]
    return (
        dealt.repartition(*keys)
        .sortWithinPartitions(*keys, "visit", "print")
        .mapInArrow(run, "a bigint, b bigint")
    )


def linked(docs: DataFrame, width: int = WIDTH, differ: int = DIFFER, layout: tuple[Block, ...] | None = None) -> DataFrame:
    """Per row of ``(doc_id, text)``: doc_id, fingerprint and component_id.

    Null, empty and blank texts have fingerprint zero and link like any other. Equal
    fingerprints link. A null id takes part but is never the least of a component, unless
    all its ids are null (then component_id is null). Repeated rows are rows of their own
    and link. Texts are read whole; other columns are ignored, whatever their names. A layout
    serves up to the `differ` that its thresholds allow; both kinds given here serve 4.

    A fingerprint has at most 679,120 others within 4 bits, whatever the number of rows,
    and rows of one fingerprint are spread over salts, so no key grows with the rows.
    """
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt")
    rows = staged(fingerprints(docs, width)).select("doc_id", "print", salt)
    groups = staged(rows.groupBy("print", "salt").agg(F.min("doc_id").alias("least")))
    prints = staged(groups.groupBy("print").agg(F.min("least").alias("least")))
    if layout is None:
        layout = NARROW if prints.count() < WIDE_FROM else WIDE
    if sum(b.threshold + 1 for b in layout) <= differ:
        raise ValueError("the layout's thresholds do not cover so many differing bits")
    labels = components(linked_prints(prints, layout, differ)).select(F.col("v").alias("print"), "label")
    placed = staged(
        prints.join(labels, "print", "left").withColumn("label", F.coalesce("label", "print"))
    )
    least = placed.groupBy("label").agg(F.min("least").alias("component_id"))
    named = placed.select("print", "label").join(least, "label").select("print", "component_id")
    found = groups.select("print", "salt").join(named, "print")
    return rows.join(found, ["print", "salt"]).select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )
