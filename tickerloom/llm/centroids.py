"""Operator 12, centroid clustering by equal-average equal-variance search.

Centroids are sorted by the mean of their components. A vector starts where its own mean
would stand and looks outward, nearest mean first. For vectors x and y of k components
with means m and deviations v (v * v is the sum of squared differences from the mean)

    distance(x, y)  >=  k * (m_x - m_y) ** 2 + (v_x - v_y) ** 2

so the first centroid whose mean alone is too far ends the search, and one whose mean and
deviation together are too far is passed over. What is left is measured in exact integers.

Each round is one scan that sends a task's sums of every cluster, never a vector; the
driver sees the centroids only (clusters times components numbers).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.stage import staged
from tickerloom.llm.vectors import matrix, scaled, usable

CLUSTERS = 16
SIZE = 64
SCALE = 64
ROUNDS = 3
SEED = "1:"
#: Squared distances of 64 such components fit 62 bits.
LIMIT = 1 << 27


class Centroids:
    """Centroids in the order of their means; `number` is a centroid's own number."""

    def __init__(self, values: np.ndarray) -> None:
        self.number = np.argsort(values.sum(axis=1), kind="stable")
        self.values = values[self.number]
        self.sums = self.values.sum(axis=1)
        self.deviations = deviations(self.values)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's nearest centroid (ties: the smaller number) and squared distance."""
        n, count = len(vectors), len(self.sums)
        size = max(1, vectors.shape[1])
        sums, spread = vectors.sum(axis=1), deviations(vectors)
        high = np.searchsorted(self.sums, sums)
        low = high - 1
        best = np.full(n, np.iinfo(np.int64).max)
        found = np.full(n, count)
        rows = np.arange(n)
        while len(rows):
            below = np.where(low[rows] >= 0, sums[rows] - self.sums[low[rows]], np.inf)
            upper = high[rows] < count
            above = np.where(upper, self.sums[np.where(upper, high[rows], 0)] - sums[rows], np.inf)
            up = above <= below
            gap = np.where(up, above, below)
            # Room for the rounding of the two bounds; what passes is measured exactly.
            room = best[rows] * (1 + 1e-9) + 1
            mean_bound = gap * gap / size
            going = mean_bound <= room
            rows, up, room, mean_bound = rows[going], up[going], room[going], mean_bound[going]
            at = np.where(up, high[rows], low[rows])
            high[rows] += up
            low[rows] -= ~up
            near = mean_bound + (spread[rows] - self.deviations[at]) ** 2 <= room
            tested, at = rows[near], at[near]
            apart = vectors[tested] - self.values[at]
            distance = np.einsum("ij,ij->i", apart, apart)
            number = self.number[at]
            better = (distance < best[tested]) | ((distance == best[tested]) & (number < found[tested]))
            best[tested[better]], found[tested[better]] = distance[better], number[better]
        return found, best


def deviations(values: np.ndarray) -> np.ndarray:
    centred = values - values.mean(axis=1, keepdims=True)
    return np.sqrt(np.einsum("ij,ij->i", centred, centred))


def seeds(vectors: DataFrame, clusters: int, size: int, seed: str) -> np.ndarray:
    """The vectors with the least hashes of their ids, as the first centroids."""
    first = (
        vectors.where("vec_id is not null")
        .select(F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256).alias("hash"), "q")
        .orderBy("hash", "q")
        .limit(clusters)
        .collect()
    )
    values = np.array([r["q"] for r in first], np.float64).reshape(len(first), size)
    if len(values) and np.abs(values).max() > LIMIT:
        raise ValueError(f"a component beyond {LIMIT} after scaling has no exact 64-bit product")
    return values.astype(np.int64)


def moved(vectors: DataFrame, values: np.ndarray) -> np.ndarray:
    """Centroids after one round: the floor of each cluster's mean, exactly."""
    count, size = values.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Centroids(values)
        total, members = np.zeros((count, size), np.int64), np.zeros(count, np.int64)
        for batch in batches:
            q = matrix(batch.column("q"), size, LIMIT)
            cluster, _ = search.nearest(q)
            np.add.at(total, cluster, q)
            members += np.bincount(cluster, minlength=count)
        yield pa.record_batch(
            [pa.array(np.arange(count)), pa.array(members), pa.array(list(total), pa.list_(pa.int64()))],
            names=["cluster", "members", "total"],
        )

    parts = vectors.select("q").mapInArrow(sums, "cluster bigint, members bigint, total array<bigint>")
    exact = "decimal(38,0)"
    rows = (
        parts.where("members > 0")
        .select("cluster", "members", F.posexplode("total").alias("at", "part"))
        .groupBy("cluster", "at")
        .agg(F.sum(F.col("part").cast(exact)).alias("total"), F.sum("members").alias("members"))
        .collect()
    )
    after = values.copy()
    for r in rows:
        after[r["cluster"], r["at"]] = int(r["total"]) // r["members"]
    return after


def assigned(vectors: DataFrame, values: np.ndarray) -> DataFrame:
    """``(vec_id, cluster, distance)`` of every vector."""
    size = values.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Centroids(values)
        for batch in batches:
            cluster, distance = search.nearest(matrix(batch.column("q"), size, LIMIT))
            yield pa.record_batch(
                [batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance)],
                names=["vec_id", "cluster", "distance"],
            )

    return vectors.select("vec_id", "q").mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def clustered(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    size: int = SIZE,
    scale: int = SCALE,
    rounds: int = ROUNDS,
    seed: str = SEED,
) -> DataFrame:
    """Per kept vector of ``(vec_id, embedding)``: cluster, distance, sums, centroid digest.

    A vector is kept if it has `size` components, none null or non-finite. Repeated rows
    are vectors of their own. Null ids are assigned but never start a centroid; without
    any id there is no centroid and the other columns are null. With fewer vectors than
    `clusters` every vector starts one. No kept vector: an empty result. Other columns are
    ignored, whatever their names. A component beyond 2^27 after scaling is an error, as
    its squared distance would not fit a long; a sum that does not fit one is null.
    """
    spark = vectors.sparkSession
    kept = vectors.where(usable(F.col("embedding"), size)).select(
        F.col("vec_id").cast("bigint"), scaled(F.col("embedding"), scale).alias("q")
    )
    values = seeds(kept, clusters, size, seed)
    if not len(values):
        return kept.select(
            "vec_id",
            F.lit(None).cast("int").alias("cluster"),
            *[F.lit(None).cast("bigint").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
            F.lit(None).cast("string").alias("centroid_sha256"),
        )
    for _ in range(rounds):
        values = moved(kept, values)
    placed = staged(assigned(kept, values))
    sums = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    inertia = {r["cluster"]: int(r["s"]) for r in sums}
    whole = sum(inertia.values())
    long = lambda n: n if n < 1 << 63 else None
    described = spark.createDataFrame(
        [
            (c, long(n), long(whole), hashlib.sha256(",".join(map(str, values[c].tolist())).encode()).hexdigest())
            for c, n in sorted(inertia.items())
        ],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    # One row a cluster, so the broadcast does not grow with the vectors.
    return placed.join(F.broadcast(described), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
