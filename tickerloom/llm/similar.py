"""Operator 3, n-gram Jaccard join: T-occurrence search over inverted lists.

A document that shares T of its n shingles with another must hold one of that one's in
any n - T + 1 of them. Shingles are ordered from rare to frequent, so those are the
short lists. As in DivideSkip the short lists are merged, with a heap, for candidates,
and the T - 1 long ones are never merged: candidates are probed for them by binary
search until T is reached or out of reach.

Equal sets are one vertex. A document is first tested against one leader, the one it
shares most lists with; lists whose documents are connected by then are done, and only
pairs that could still join two components follow. So a large group of copies never becomes all its pairs.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm import kernel as K
from tickerloom.llm.countmin import MAX_CELLS_LOG2, estimated_repeated, repeated_cells
from tickerloom.llm.stage import staged

SHINGLE = 3
#: Link when ``100 * intersection >= PERCENT * union``.
PERCENT = 90
#: Cells of the frequency sketch, one byte each (16 MB); it only orders the shingles.
CELLS_LOG2 = 24
SLICE_LOG2 = 18
#: Estimated document counts from which a shingle belongs to a more frequent class.
CLASSES = (24, 64, 255)
FILTER_LOG2 = 23


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """Each row's distinct shingle hashes; fewer words than `width` are one shingle."""
    data = K.LOWER[data]
    starts, ends, bounds = K.words(data, offsets, K.NOT_BLANK)
    ranges = K.Ranges(K.word_hashes(data, starts, ends))
    grams = ranges.fixed(width)
    short = ranges.hash(bounds[:-1], bounds[1:])
    out = []
    for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        if b - a >= width:
            out.append(np.unique(grams[a : b - width + 1]))
        else:
            out.append(short[k : k + 1] if b > a else grams[:0])
    return out


def _batches_of_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple]:
    for batch in batches:
        for first, last, data, offsets in K.text_slices(batch.column("text")):
            yield batch.slice(first, last - first), shingle_sets(data, offsets, width)


def frequency_sketch(docs: DataFrame, width: int, log2: int) -> np.ndarray:
    """Saturating document counts by hash cell, merged over all documents."""
    part = min(SLICE_LOG2, log2)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(1 << log2, np.uint8)
        for _, sets in _batches_of_sets(batches, width):
            if sets:
                cells, n = np.unique(
                    (np.concatenate(sets) >> np.uint64(64 - log2)).astype(np.int64), return_counts=True
                )
                count[cells] = np.minimum(count[cells].astype(np.int64) + n, 255)
        used = [(s, c) for s, c in enumerate(count.reshape(-1, 1 << part)) if c.any()]
        yield pa.record_batch(
            [pa.array([s for s, _ in used], pa.int32()), pa.array([c.tobytes() for _, c in used], pa.binary())],
            names=["slice", "counts"],
        )

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(1 << part, np.int64)
        for counts in frame["counts"]:
            total += np.frombuffer(counts, np.uint8)
        return pd.DataFrame([(frame["slice"].iloc[0], np.minimum(total, 255).astype(np.uint8).tobytes())])

    merged = np.zeros(1 << log2, np.uint8)
    rows = (
        docs.select("text")
        .mapInArrow(partial, "slice int, counts binary")
        .groupBy("slice")
        .applyInPandas(merge, "slice int, counts binary")
    )
    for s, counts in rows.toLocalIterator():
        merged[s << part : (s + 1) << part] = np.frombuffer(counts, np.uint8)
    return merged


def in_order(values: np.ndarray, sketch: np.ndarray, log2: int) -> np.ndarray:
    """Shingles as ordered numbers: the frequency class in front, then the hash."""
    estimate = sketch[(values >> np.uint64(64 - log2)).astype(np.int64)]
    kind = np.searchsorted(CLASSES, estimate, side="right").astype(np.uint64)
    return np.sort((kind << np.uint64(61)) | (values >> np.uint64(3))).astype(np.int64)


def required(n_a: np.ndarray | int, n_b: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The least intersection with which sets of these sizes link."""
    return -(-percent * (n_a + n_b) // (100 + percent))


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def probed_overlap(a: np.ndarray, b: np.ndarray, need: int) -> bool:
    """Whether two ordered sets share `need` values.

    The head of `a`, its short lists, is merged with `b` by a heap; the rest is probed in
    `b` by binary search, block by block, until the need is met or cannot be met.
    """
    if len(a) > len(b):
        a, b = b, a
    head = min(len(a), len(a) - need + 1)
    if head < 1:
        return False
    merged = list(heapq.merge(a[:head].tolist(), b[: len(b) - need + 1].tolist()))
    found = sum(x == y for x, y in zip(merged, merged[1:], strict=False))
    if not found:
        return False
    found = _probe(a[:head], b)
    at, step = head, 64
    while found < need and at < len(a):
        if found + len(a) - at < need:
            return False
        found += _probe(a[at : at + step], b)
        at, step = at + step, step * 2
    return found >= need


def _probe(values: np.ndarray, among: np.ndarray) -> int:
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return int((among[at] == values).sum())


def _described(docs: DataFrame, sketch, width: int, percent: int, log2: int) -> DataFrame:
    """Per row: id, text hash, set size, set key, and the packed short lists of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, sets in _batches_of_sets(batches, width):
            sizes = [len(s) for s in sets]
            keys = [set_key(s) for s in sets]
            heads = [
                in_order(s, sketch.value, log2)[: prefix_size(len(s), percent)].tobytes() for s in sets
            ]
            yield pa.record_batch(
                [
                    rows.column("doc_id"),
                    rows.column("text_hash"),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.int64()),
                    pa.array(heads, pa.binary()),
                ],
                names=["doc_id", "text_hash", "n", "v", "head"],
            )

    return docs.mapInArrow(run, "doc_id bigint, text_hash bigint, n bigint, v bigint, head binary")


def set_key(items: np.ndarray) -> int:
    """64 bits that name a set of shingles: its vertex."""
    return int(np.bitwise_xor.reduce(K._mix(items), initial=np.uint64(len(items))).astype(np.int64))


def _heads(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(h.as_py(), np.int64) for h in batch.column("head")]


def _postings(distinct: DataFrame) -> DataFrame:
    """``(o, pos, n, v)`` for the short lists of every distinct set that another may be in.

    A count-min sketch of the short lists leaves out lists of one, without a shuffle of all.
    """
    entries = distinct.agg(F.sum(F.length("head"))).first()[0] or 0
    log2 = min(MAX_CELLS_LOG2, max(12, int(entries).bit_length()))
    cells = repeated_cells(
        distinct.select("head"),
        lambda batch: iter([K._mix(h.astype(np.uint64)) for h in [np.concatenate(_heads(batch) or [np.empty(0, np.int64)])]]),
        log2,
    )
    shared = distinct.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = _heads(batch)
            sizes = np.array([len(h) for h in heads], np.int64)
            n, v = batch.column("n").to_numpy(), batch.column("v").to_numpy()
            flat = np.concatenate(heads) if heads else np.empty(0, np.int64)
            keep = estimated_repeated(K._mix(flat.astype(np.uint64)), shared.value, log2)
            yield pa.record_batch(
                [
                    pa.array(flat[keep], pa.int64()),
                    pa.array(K.ragged(np.zeros_like(sizes), sizes)[keep].astype(np.int32)),
                    pa.array(np.repeat(n, sizes)[keep].astype(np.int32)),
                    pa.array(np.repeat(v, sizes)[keep]),
                ],
                names=["o", "pos", "n", "v"],
            )

    return distinct.mapInArrow(run, "o bigint, pos int, n int, v bigint")


def _possible(a: str, b: str, percent: int) -> F.Column:
    """Whether the pair can reach its overlap if the list is the first that both are in."""
    n_a, n_b = F.col(f"{a}n"), F.col(f"{b}n")
    need = F.ceil((n_a + n_b) * percent / (100 + percent))
    return F.lit(1) + F.least(n_a - F.col(f"{a}pos"), n_b - F.col(f"{b}pos")) - 1 >= need


def heads_allow(a: np.ndarray, n_a: int, b: np.ndarray, n_b: int, percent: int) -> bool:
    """Whether two sets can link, from their short lists alone.

    The heads are merged by a heap, as far as both reach. What they share there is known;
    behind it each set has so many shingles left.
    """
    if not len(a) or not len(b):
        return False
    reach = min(a[-1], b[-1])
    merged = heapq.merge(a[a <= reach].tolist(), b[b <= reach].tolist())
    seen = shared = 0
    before = None
    for item in merged:
        seen += 1
        shared += item == before
        before = item
    in_a = int(np.searchsorted(a, reach, side="right"))
    return shared + min(n_a - in_a, n_b - (seen - in_a)) >= required(n_a, n_b, percent)


def _merged(pairs: DataFrame, distinct: DataFrame, percent: int) -> DataFrame:
    """The pairs that the merge of their short lists leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [batch.column(c).to_pylist() for c in ("n_a", "n_b")]
            heads = [[np.frombuffer(h.as_py(), np.int64) for h in batch.column(c)] for c in ("head_a", "head_b")]
            keep = [
                heads_allow(a, n_a, b, n_b, percent)
                for a, n_a, b, n_b in zip(heads[0], sizes[0], heads[1], sizes[1], strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    for side in ("a", "b"):
        head = distinct.select(
            F.col("v").alias(side), F.col("n").alias(f"n_{side}"), F.col("head").alias(f"head_{side}")
        )
        pairs = pairs.join(head, side)
    return pairs.select("a", "b", "n_a", "n_b", "head_a", "head_b").mapInArrow(run, "a bigint, b bigint")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("items_a"), batch.column("items_b"), strict=True):
                a, b = (np.frombuffer(v.as_py(), np.int64) for v in (x, y))
                keep.append(probed_overlap(a, b, int(required(len(a), len(b), percent))))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    a, b = (
        sets.join(pairs.select(F.col(side).alias("v")).distinct(), "v", "left_semi").select(
            F.col("v").alias(side), F.col("items").alias(f"items_{side}")
        )
        for side in ("a", "b")
    )
    return pairs.join(a, "a").join(b, "b").select("a", "b", "items_a", "items_b").mapInArrow(
        run, "a bigint, b bigint"
    )


def components(edges: DataFrame) -> DataFrame:
    """``(v, label)`` of every vertex with an edge: the least vertex it reaches.

    Each round takes the least label among neighbours, then the label's own label, so
    that labels travel twice as far a round.
    """
    both = staged(edges.union(edges.select("b", "a")).toDF("v", "u").distinct())
    labels = both.groupBy("v").agg(F.least(F.col("v"), F.min("u")).alias("label"))
    labels = staged(labels)
    while True:
        near = (
            both.join(labels.select(F.col("v").alias("u"), "label"), "u").groupBy("v").agg(F.min("label").alias("near"))
        )
        far = labels.select(F.col("v").alias("near"), F.col("label").alias("far"))
        after = (
            labels.join(near, "v")
            .withColumn("near", F.least("label", "near"))
            .join(far, "near", "left")
            .select("v", F.least("near", F.coalesce("far", "near")).alias("label"), F.col("label").alias("before"))
        )
        after = staged(after)
        if after.where("label <> before").isEmpty():
            return after.select("v", "label")
        labels = after.select("v", "label")


def linked(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row: id, text hash, set size, vertex, and its component's label and least id.

    Null or empty texts have an empty set and link with nothing; their component is their
    own id. Null ids take part but are never the least id of a component, unless all are
    null. Repeated rows are one vertex. Texts are read whole.
    """
    K.modest_batches(docs.sparkSession)
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint"), "text").withColumn("text_hash", F.xxhash64("text"))
    log2 = min(CELLS_LOG2, max(12, K.total_bytes(rows).bit_length() - 3))
    sketch = spark.sparkContext.broadcast(frequency_sketch(rows, width, log2))
    described = staged(_described(rows, sketch, width, percent, log2))

    distinct = staged(
        described.where("n > 0").groupBy("v").agg(F.first("n").alias("n"), F.first("head").alias("head"))
    )
    postings = _postings(distinct)
    shared = postings.groupBy("o").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("o")
    lists = staged(postings.join(shared, "o"))
    leader = lists.groupBy("o").agg(F.min(F.struct("pos", "n", "v")).alias("l"))
    first = (
        lists.join(leader.select("o", F.col("l.pos").alias("l_pos"), F.col("l.n").alias("l_n"), F.col("l.v").alias("l_v")), "o")
        .where(F.col("v") != F.col("l_v"))
        .where(_possible("", "l_", percent))
        .groupBy(F.col("v").alias("a"), F.col("l_v").alias("b"))
        .agg(F.count(F.lit(1)).alias("m"))
        .groupBy("a")
        .agg(F.max_by("b", F.struct("m", "b")).alias("b"))
    )
    first = staged(_merged(first, distinct, percent))
    sets = _sets_of(rows, described, first, sketch, width, log2)
    stars = staged(_verified(first, sets, percent))
    labels = components(stars)

    placed = staged(
        lists.join(labels, "v", "left").withColumn("label", F.coalesce("label", "v"))
    )
    mixed = placed.groupBy("o").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("o")
    open_lists = placed.join(mixed, "o")
    a = open_lists.select("o", *[F.col(c).alias(f"a_{c}") for c in ("pos", "n", "v", "label")])
    b = open_lists.select("o", *[F.col(c).alias(f"b_{c}") for c in ("pos", "n", "v", "label")])
    rest = (
        a.join(b, "o")
        .where((F.col("a_v") < F.col("b_v")) & (F.col("a_label") != F.col("b_label")))
        .where(_possible("a_", "b_", percent))
        .select(F.col("a_v").alias("a"), F.col("b_v").alias("b"))
        .distinct()
        .join(first, ["a", "b"], "left_anti")
        .join(first.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_anti")
    )
    rest = staged(_merged(rest, distinct, percent))
    if not rest.isEmpty():
        more = _verified(rest, _sets_of(rows, described, rest, sketch, width, log2), percent)
        labels = components(stars.union(more))
    placed_rows = described.select("doc_id", "text_hash", "n", "v").join(labels, "v", "left").withColumn(
        "label", F.coalesce("label", "v")
    )
    least = placed_rows.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("least"))
    return placed_rows.join(least, "label", "left").select(
        "doc_id",
        "text_hash",
        "n",
        "v",
        "label",
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _sets_of(
    rows: DataFrame, described: DataFrame, pairs: DataFrame, sketch, width: int, log2: int
) -> DataFrame:
    """``(v, items)`` of the vertices in `pairs`, each made anew from one row that has it.

    The rows are named by a bit filter of fixed size; what passes it by chance does no harm.
    """
    needed = pairs.select(F.col("a").alias("v")).union(pairs.select("b")).distinct()
    cell = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(1 << FILTER_LOG2)).cast("int")
    one = described.join(needed, "v").groupBy("v").agg(F.min(F.struct("doc_id", "text_hash")).alias("one"))
    packed = one.select("one.*").select(cell.alias("c")).groupBy((F.col("c") / 1024).cast("int").alias("w"))
    bits = np.zeros(1 << FILTER_LOG2, bool)
    for _, cells in packed.agg(F.collect_set("c").alias("c")).toLocalIterator():
        bits[cells] = True
    shared = rows.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            hit = (shared.value[cells >> 3] >> (7 - (cells & 7)) & 1).astype(bool)
            for _, sets in _batches_of_sets(iter([batch.filter(pa.array(hit))]), width):
                packed = [in_order(s, sketch.value, log2).tobytes() for s in sets]
                yield pa.record_batch(
                    [pa.array([set_key(s) for s in sets], pa.int64()), pa.array(packed, pa.binary())],
                    names=["v", "items"],
                )

    return staged(rows.select("text", cell.alias("cell")).mapInArrow(run, "v bigint, items binary"))


def keep_one(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each component, that of the least id, with all its columns.

    Of rows that are alike in id and text one stays. Documents without words all stay.
    """
    names = docs.columns
    # Columns go by number meanwhile, so that none can be taken for one made here.
    docs = docs.toDF(*[c if c in ("doc_id", "text") else f"c{k}" for k, c in enumerate(names)])
    rows = linked(docs, width, percent)
    filled = F.col("n") > 0
    group = F.struct(
        filled.alias("filled"),
        F.when(filled, F.col("label")).otherwise(F.col("doc_id")).alias("of"),
        F.when(~filled, F.col("text_hash")).alias("hash"),
    )
    key = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    kept = staged(
        rows.select(group.alias("g"), key.alias("k"))
        .groupBy("g")
        .agg(F.min("k").alias("k"), F.count(F.lit(1)).alias("n"))
        .select(F.col("k.doc_id").alias("_id"), F.col("k.text_hash").alias("_hash"), "n")
    )
    hashed = docs.withColumn("_text_hash", F.xxhash64("text"))
    same = F.col("_id").eqNullSafe(hashed["doc_id"]) & (F.col("_hash") == F.col("_text_hash"))
    single = hashed.join(kept, same, "left_semi")
    twice = rows.groupBy("doc_id", "text_hash").count().where("count > 1")
    twice = staged(twice.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")))
    if twice.isEmpty():
        return single.drop("_text_hash").toDF(*names)
    once = single.join(twice, same, "left_anti")
    again = single.join(twice, same, "left_semi").dropDuplicates(["doc_id", "_text_hash"])
    return once.unionByName(again).drop("_text_hash").toDF(*names)
