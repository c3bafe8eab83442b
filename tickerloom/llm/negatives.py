"""Operator 11, hard-negative mining over Hilbert-ordered blocks with zone maps.

Rows are written in the order of a Hilbert curve through the grid of their components, in
shelves of blocks: one Parquet row a shelf, with the least and greatest value of every
component of every block beside it. For an anchor a and a block with bounds l and u,

    sum(min(a_d * l_d, a_d * u_d))  <=  score  <=  sum(max(a_d * l_d, a_d * u_d))

by interval arithmetic. An anchor asks for a window of scores. It first searches its own
shelf, which gives each window a floor (the score of its last place so far); the zone maps
alone then tell which other shelves hold a block that can reach into the window above the
floor. Only those are sent, each once, to where the anchors that want it come by.

Positives are one window without bounds over the anchor's label; the negatives of each
positive are a window between two shares of its score over the other labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.llm.stage import staged
from tickerloom.llm.vectors import matrix, scaled, usable

SCALE = 256
ANCHOR_EVERY = 50
POSITIVES = 5
NEGATIVES = 3
#: Shares of the positive's score, in percent, between which a negative is hard.
LEAST, MOST = 50, 95
BLOCK = 256
BLOCKS = 32
#: Grid bits a component on the curve.
BITS = 2
#: Shelves whose zone maps are searched together, and the parts by which packs are spread.
ATLAS = 64
SPREAD = 16
#: Stands for a null id in packed rows; it sorts last.
NO_ID = np.iinfo(np.int64).max

PACK = (
    "shelf bigint, places binary, ids binary, labels binary, q binary, "
    "owner binary, ordinal binary, low binary, high binary, floor binary"
)
FOUND = "anchor bigint, ordinal int, vec_id bigint, place bigint, score bigint"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of grid cells, as big-endian bytes."""
    x = cells.astype(np.int64).copy()
    size = x.shape[1]
    turn = 1 << (bits - 1)
    while turn > 1:
        mask = turn - 1
        for d in range(size):
            ones = (x[:, d] & turn) != 0
            swap = np.where(ones, 0, (x[:, 0] ^ x[:, d]) & mask)
            x[:, 0] ^= np.where(ones, mask, swap)
            x[:, d] ^= swap
        turn >>= 1
    x = np.bitwise_xor.accumulate(x, axis=1)
    flip = np.zeros(len(x), np.int64)
    turn = 1 << (bits - 1)
    while turn > 1:
        flip ^= np.where(x[:, -1] & turn, turn - 1, 0)
        turn >>= 1
    x ^= flip[:, None]
    planes = [(x >> b & 1).astype(np.uint8) for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes, axis=1), axis=1)


@dataclass(frozen=True)
class Shape:
    """Components of a vector, rows of a block, blocks of a shelf."""

    size: int
    block: int = BLOCK
    blocks: int = BLOCKS

    @property
    def rows(self) -> int:
        return self.block * self.blocks


@dataclass
class Shelf:
    """Consecutive rows on the curve, cut into blocks, ordered by id within a block."""

    shape: Shape
    number: int
    ids: np.ndarray
    labels: np.ndarray
    q: np.ndarray
    low: np.ndarray
    high: np.ndarray

    SCHEMA = "shelf bigint, ids binary, labels binary, q binary, low binary, high binary"

    @classmethod
    def of(cls, shape: Shape, number: int, ids: np.ndarray, labels: np.ndarray, q: np.ndarray) -> Shelf:
        starts = np.arange(0, len(ids), shape.block)
        order = np.lexsort((ids, np.arange(len(ids)) // shape.block))
        ids, labels, q = ids[order], labels[order], q[order]
        return cls(shape, number, ids, labels, q, np.minimum.reduceat(q, starts), np.maximum.reduceat(q, starts))

    @classmethod
    def read(cls, row: dict, shape: Shape) -> Shelf:
        return cls(
            shape,
            row["shelf"],
            np.frombuffer(row["ids"], np.int64),
            np.frombuffer(row["labels"], np.int64),
            *[np.frombuffer(row[c], np.int32).reshape(-1, shape.size) for c in ("q", "low", "high")],
        )

    def batch(self) -> pa.RecordBatch:
        parts = [x.tobytes() for x in (self.ids, self.labels, *[x.astype(np.int32) for x in (self.q, self.low, self.high)])]
        return pa.record_batch(
            [pa.array([self.number], pa.int64()), *[pa.array([p], pa.binary()) for p in parts]],
            names=["shelf", "ids", "labels", "q", "low", "high"],
        )

    @property
    def places(self) -> np.ndarray:
        """Numbers of the rows, unlike for all rows."""
        return self.number * self.shape.rows + np.arange(len(self.ids))


@dataclass
class Pack:
    """The anchors of one shelf and the windows they ask for."""

    shelf: int
    places: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    q: np.ndarray
    owner: np.ndarray
    ordinal: np.ndarray
    low: np.ndarray
    high: np.ndarray
    floor: np.ndarray

    @classmethod
    def of(cls, shelf: Shelf) -> Pack:
        """The anchors, each with one window without bounds."""
        at = np.flatnonzero((shelf.ids % ANCHOR_EVERY == 0) & (shelf.ids != NO_ID))
        n = len(at)
        none = np.full(n, -np.inf)
        owner, ordinal = np.arange(n, dtype=np.int32), np.zeros(n, np.int32)
        anchors = shelf.places[at], shelf.ids[at], shelf.labels[at], shelf.q[at]
        return cls(shelf.number, *anchors, owner, ordinal, none, -none, none)

    @classmethod
    def read(cls, row: dict, shape: Shape) -> Pack:
        kinds = [np.int64] * 3 + [np.int32] * 3 + [np.float64] * 3
        names = ("places", "ids", "labels", "q", "owner", "ordinal", "low", "high", "floor")
        out = cls(row["shelf"], *[np.frombuffer(row[c], k) for c, k in zip(names, kinds, strict=True)])
        out.q = out.q.reshape(-1, shape.size)
        return out

    def batch(self) -> pa.RecordBatch:
        names = ("places", "ids", "labels", "q", "owner", "ordinal", "low", "high", "floor")
        return pa.record_batch(
            [pa.array([self.shelf], pa.int64()), *[pa.array([getattr(self, c).tobytes()], pa.binary()) for c in names]],
            names=["shelf", *names],
        )

    def bounds(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible score of each anchor in each block."""
        up, down = np.maximum(self.q, 0).astype(float), np.minimum(self.q, 0).astype(float)
        return up @ low.T + down @ high.T, up @ high.T + down @ low.T

    def wants(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Windows by blocks: true where the block can hold a score in the window, above its floor."""
        least, most = self.bounds(low, high)
        above = np.maximum(self.low, self.floor)[:, None]
        return (most[self.owner] >= above) & (least[self.owner] <= self.high[:, None])

    def search(self, shelf: Shelf, same: bool, count: int) -> np.ndarray:
        """``(window, place on the shelf, score)`` of the best rows of each window.

        A row that ties with the last place is returned if its id is smaller.
        """
        wanted = self.wants(shelf.low, shelf.high)
        best = np.full((len(self.owner), count), -np.inf)
        q = self.q.astype(float)
        out = [np.zeros((3, 0))]
        for b in np.flatnonzero(wanted.any(axis=0)):
            at = slice(b * shelf.shape.block, (b + 1) * shelf.shape.block)
            windows = np.flatnonzero(wanted[:, b])
            owners, back = np.unique(self.owner[windows], return_inverse=True)
            scores = q[owners] @ shelf.q[at].T.astype(float)
            other = (shelf.labels[at] == self.labels[owners][:, None]) != same
            other |= shelf.places[at] == self.places[owners][:, None]
            scores[other] = -np.inf
            scores = scores[back]
            above = np.maximum(self.low[windows], self.floor[windows])
            scores[(scores < above[:, None]) | (scores > self.high[windows][:, None])] = -np.inf
            windows = windows[(open_ := (scores > -np.inf).any(axis=1))]
            scores, k = scores[open_], np.arange(open_.sum())
            kept = np.full((len(windows), count), -np.inf)
            for c in range(min(count, scores.shape[1])):
                # Rows of a block lie by id, so the first of equal scores has the least id.
                first = scores.argmax(axis=1)
                kept[:, c] = scores[k, first]
                there = kept[:, c] > -np.inf
                out.append(np.stack((windows[there], at.start + first[there], kept[there, c])))
                scores[k, first] = -np.inf
            best[windows] = np.sort(np.concatenate((best[windows], kept), axis=1), axis=1)[:, -count:]
            self.floor[windows] = np.maximum(self.floor[windows], best[windows, 0])
        found = np.concatenate(out, axis=1)
        found = found[:, found[2] >= self.floor[found[0].astype(np.int64)]]
        order = np.lexsort((shelf.places[found[1].astype(np.int64)], shelf.ids[found[1].astype(np.int64)], -found[2], found[0]))
        found = found[:, order]
        rank = np.arange(found.shape[1]) - np.searchsorted(found[0], found[0])
        return found[:, rank < count]

    def found(self, shelf: Shelf, same: bool, count: int) -> pa.RecordBatch:
        self.floor = self.floor.copy()
        window, at, score = self.search(shelf, same, count)
        window, at = window.astype(np.int64), at.astype(np.int64)
        return pa.record_batch(
            [
                pa.array(self.places[self.owner[window]]),
                pa.array(self.ordinal[window]),
                pa.array(shelf.ids[at]),
                pa.array(shelf.places[at]),
                pa.array(score.astype(np.int64)),
            ],
            names=["anchor", "ordinal", "vec_id", "place", "score"],
        )


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """One row at a time, its binary columns as buffers, not copies."""
    for i in range(batch.num_rows):
        yield {
            n: c[i].as_buffer() if pa.types.is_binary(c.type) and c[i].is_valid else c[i].as_py()
            for n, c in zip(batch.schema.names, batch.columns, strict=True)
        }


def _one_shelf_a_batch(df: DataFrame) -> None:
    """Shelves are rows of some megabytes, so a batch must be bounded by bytes."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def prepared(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, label, q)`` of the rows that take part."""
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return (
        vectors.select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), "embedding")
        .where(F.col("label").isNotNull() & usable(F.col("embedding")))
        .select("vec_id", changed.alias("label"), scaled(F.col("embedding"), scale).alias("q"))
    )


def grid(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Least and greatest value of every component, and how many there are (one at least)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.zeros(0), np.zeros(0)
        for batch in batches:
            lengths = batch.column("q").value_lengths().to_numpy(zero_copy_only=False)
            if not len(lengths):
                continue
            size = max(len(low), int(lengths.max()))
            q = matrix(batch.column("q"), size, 1 << 31)
            pad = (0, size - len(low))
            low, high = np.minimum(np.pad(low, pad), q.min(axis=0)), np.maximum(np.pad(high, pad), q.max(axis=0))
        lists = pa.list_(pa.float64())
        yield pa.record_batch([pa.array([low], lists), pa.array([high], lists)], names=["low", "high"])

    parts = rows.select("q").mapInArrow(run, "low array<double>, high array<double>")
    found = (
        parts.select(F.posexplode(F.arrays_zip("low", "high")).alias("at", "v"))
        .groupBy("at")
        .agg(F.min("v.low").alias("low"), F.max("v.high").alias("high"))
        .orderBy("at")
        .collect()
    )
    if not found:
        return np.zeros(1), np.zeros(1), 1
    return np.array([r["low"] for r in found]), np.array([r["high"] for r in found]), len(found)


def shelved(rows: DataFrame, low: np.ndarray, high: np.ndarray, shape: Shape) -> DataFrame:
    """The rows in curve order, in shelves."""
    size = shape.size
    limit = int(((1 << 53) / size) ** 0.5)
    width = np.maximum(high - low, 1)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = matrix(batch.column("q"), size, limit)
            cells = np.clip(((q - low) / width * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
            keys = hilbert_keys(cells, BITS)
            packed = q.astype(np.int32)
            yield pa.record_batch(
                [
                    pa.array([k.tobytes() for k in keys], pa.binary()),
                    batch.column("vec_id"),
                    batch.column("label"),
                    pa.array([v.tobytes() for v in packed], pa.binary()),
                ],
                names=["key", "vec_id", "label", "q"],
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, shape.rows - rows)
                held.append(part)
                rows += part.num_rows
                batch = batch.slice(part.num_rows)
                if rows == shape.rows:
                    yield shelf(first, held)
                    first, held, rows = first + 1, [], 0
        if rows:
            yield shelf(first, held)

    def shelf(number: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        ids = table["vec_id"].fill_null(NO_ID).to_numpy()
        q = np.frombuffer(b"".join(v.as_py() for v in table["q"]), np.int32).reshape(len(ids), size)
        return Shelf.of(shape, number, ids, table["label"].to_numpy(), q).batch()

    order = ["key", "vec_id", "label", "q"]
    return (
        rows.mapInArrow(keyed, "key binary, vec_id bigint, label bigint, q binary")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(cut, Shelf.SCHEMA)
    )


def packs_of(shelves: DataFrame, shape: Shape) -> DataFrame:
    """Each shelf's anchors, asking for positives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                pack = Pack.of(Shelf.read(row, shape))
                if len(pack.ids):
                    yield pack.batch()

    return shelves.select("shelf", "ids", "labels", "q", "low", "high").mapInArrow(run, PACK)


def searched(shelves: DataFrame, packs: DataFrame, wanted: DataFrame, shape: Shape, same: bool, count: int) -> DataFrame:
    """The best rows of every window in the shelves that `wanted` (pack, shelf) names.

    Shelves and packs meet where a shelf's number sends them: the shelf comes first and is
    the only one held, then the packs that want it, one by one.
    """
    columns = ("places", "ids", "labels", "q", "owner", "ordinal", "low", "high", "floor")
    absent = F.lit(None).cast("binary")
    stock = shelves.join(wanted.select("shelf").distinct(), "shelf", "left_semi").select(
        F.col("shelf").alias("at"),
        F.lit(-1).cast("bigint").alias("shelf"),
        *[(F.col(c) if c in shelves.columns else absent).alias(c) for c in columns],
    )
    asking = wanted.select(F.col("shelf").alias("at"), F.col("pack").alias("shelf")).join(packs, "shelf")
    both = stock.unionByName(asking.select("at", "shelf", *columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Shelf | None = None
        for batch in batches:
            for row in _rows(batch):
                if row["shelf"] == -1:
                    held = Shelf.read({**row, "shelf": row["at"]}, shape)
                elif held is not None and held.number == row["at"]:
                    yield Pack.read(row, shape).found(held, same, count)

    return both.repartition("at").sortWithinPartitions("at", "shelf").mapInArrow(run, FOUND)


def best(found: DataFrame, count: int) -> DataFrame:
    """The first `count` of each anchor's window, with their rank."""
    order = Window.partitionBy("anchor", "ordinal").orderBy(F.desc("score"), "vec_id", "place")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def refilled(packs: DataFrame, rows: DataFrame, shape: Shape, windows: bool, count: int) -> DataFrame:
    """The packs with new windows (`windows`: one of each row), or else with floors from `rows`.

    A pack has at most one shelf's anchors, so the rows gathered for it are bounded too.
    """
    shelf = F.expr(f"anchor div {shape.rows}").alias("shelf")
    gathered = (
        rows.select(shelf, "anchor", "ordinal", "rank", "score")
        .groupBy("shelf")
        .agg(*[F.collect_list(c).alias(f"r_{c}") for c in ("anchor", "ordinal", "rank", "score")])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                pack = Pack.read(row, shape)
                anchor, ordinal, rank, score = (
                    np.array(row[f"r_{c}"] or [], np.int64) for c in ("anchor", "ordinal", "rank", "score")
                )
                owner = np.searchsorted(pack.places, anchor)
                if windows:
                    low, high = -(-LEAST * score // 100), MOST * score // 100
                    open_ = low <= high
                    pack.owner, pack.ordinal = owner[open_].astype(np.int32), rank[open_].astype(np.int32)
                    pack.low, pack.high = low[open_].astype(float), high[open_].astype(float)
                    pack.floor = np.full(len(pack.low), -np.inf)
                else:
                    last = rank == count
                    of = {k: i for i, k in enumerate(zip(pack.owner.tolist(), pack.ordinal.tolist(), strict=True))}
                    at = [of[k] for k in zip(owner[last].tolist(), ordinal[last].tolist(), strict=True)]
                    pack.floor = pack.floor.copy()
                    pack.floor[at] = score[last]
                if len(pack.owner):
                    yield pack.batch()

    return packs.join(gathered, "shelf", "left").mapInArrow(run, PACK)


def wanted_shelves(packs: DataFrame, zones: DataFrame, atlases: int, shape: Shape) -> DataFrame:
    """``(pack, shelf)`` where the zone map of a block of the shelf reaches a window of the pack.

    Zone maps lie together in atlases of about `ATLAS` shelves; packs pass every atlas.
    """
    gathered = zones.groupBy(F.pmod(F.xxhash64("shelf"), F.lit(atlases)).alias("atlas")).agg(
        F.collect_list(F.struct("shelf", "low", "high")).alias("zones")
    )
    salted = gathered.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    asking = packs.withColumn("salt", F.pmod(F.xxhash64("shelf"), F.lit(SPREAD)).cast("int")).withColumn(
        "atlas", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(atlases - 1).cast("bigint")))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                pack = Pack.read(row, shape)
                shelf, low, high = [], [], []
                for zone in row["zones"]:
                    low.append(np.frombuffer(zone["low"], np.int32).reshape(-1, shape.size))
                    high.append(np.frombuffer(zone["high"], np.int32).reshape(-1, shape.size))
                    shelf += [zone["shelf"]] * len(low[-1])
                some = pack.wants(np.concatenate(low), np.concatenate(high)).any(axis=0)
                names = np.unique(np.array(shelf)[some])
                names = names[names != pack.shelf]
                yield pa.record_batch([pa.array(np.full(len(names), pack.shelf)), pa.array(names)], names=["pack", "shelf"])

    return asking.join(salted, ["atlas", "salt"]).mapInArrow(run, "pack bigint, shelf bigint")


def mined(vectors: DataFrame, scale: int = SCALE, block: int = BLOCK, blocks: int = BLOCKS) -> DataFrame:
    """Hard negatives of every anchor and positive, as the contract of operator 11 has them.

    Rows with a null label, vector or component, or a non-finite one, take no part. A null
    id is never an anchor and comes last among ties (2^63 - 1 is taken for null). Vectors of
    unlike lengths are compared as if filled with zeros. Repeated rows are rows of their
    own: each may be the other's positive. Ties go by id, then by place on the curve.
    Positives without a negative give no row; an empty table gives none at all. Components
    so large that products are not exact in 53 bits are an error. Other columns are
    ignored, whatever their names.
    """
    _one_shelf_a_batch(vectors)
    rows = prepared(vectors, scale)
    low, high, size = grid(rows)
    shape = Shape(size, block, blocks)
    shelves = staged(shelved(rows, low, high, shape))
    zones = shelves.select("shelf", "low", "high")
    atlases = max(1, -(-shelves.select("shelf").count() // ATLAS))
    own = F.col("shelf").alias("pack"), F.col("shelf")

    def best_of(packs: DataFrame, same: bool, count: int) -> DataFrame:
        home = staged(best(searched(shelves, packs, packs.select(*own), shape, same, count), count))
        raised = staged(refilled(packs, home, shape, False, count))
        wanted = staged(wanted_shelves(raised, zones, atlases, shape))
        away = searched(shelves, raised, wanted, shape, same, count)
        return staged(best(home.drop("rank").unionByName(away), count))

    packs = staged(packs_of(shelves, shape))
    positives = best_of(packs, True, POSITIVES)
    asked = staged(refilled(packs, positives, shape, True, POSITIVES))
    negatives = best_of(asked, False, NEGATIVES)
    anchors = F.col("vec_id").alias("negative_id")
    named = negatives.select("anchor", "ordinal", "rank", anchors, F.col("score").alias("negative_score")).join(
        positives.select(
            "anchor", F.col("rank").alias("ordinal"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
        ),
        ["anchor", "ordinal"],
    )
    known = lambda c: F.when(F.col(c) != F.lit(int(NO_ID)), F.col(c)).alias(c)
    return named.join(_anchor_ids(packs), "anchor").select(
        "anchor_id", known("positive_id"), F.col("rank").cast("int").alias("rank"), known("negative_id"),
        "positive_score", "negative_score",
    )


def _anchor_ids(packs: DataFrame) -> DataFrame:
    """``(anchor, anchor_id)``: the id of every anchor's row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                columns = [pa.array(np.frombuffer(row[c], np.int64)) for c in ("places", "ids")]
                yield pa.record_batch(columns, names=["anchor", "anchor_id"])

    return packs.select("places", "ids").mapInArrow(run, "anchor bigint, anchor_id bigint")
