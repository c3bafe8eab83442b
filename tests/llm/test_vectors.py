"""Operators over vectors, against brute force; nulls, ties, repeated rows, odd lengths included."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from tickerloom.llm import centroids, negatives

ROWS = "vec_id bigint, embedding array<float>, label int, shelf bigint, q string, cluster int, distance string, place int"


@pytest.fixture(scope="module")
def vectors() -> list[tuple]:
    rng = np.random.default_rng(7)
    middle = rng.standard_normal((6, 64)) * 0.2
    out = []
    for i in range(700):
        v = (middle[i % 6] + rng.standard_normal(64) * 0.1).astype(np.float32).tolist()
        out.append((i, v, i % 4 if i % 31 else None))
    out += [(i, out[3][1], 3) for i in range(1000, 1200)]
    out += [(1500, None, 1), (1550, [*out[0][1][:63], None], 1), (1600, [*out[0][1][:63], float("nan")], 1)]
    out += [(1650, [*out[0][1][:63], float("inf")], 2), (-50, out[5][1], 2), (-7, out[8][1], 9), (None, out[9][1], 0)]
    return out


def frame(spark, rows: list[tuple]):
    return spark.createDataFrame([(*r, 1, "q", 2, "d", 3) for r in rows], ROWS).repartition(3)


def sound(v) -> bool:
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def hard_negatives(rows: list[tuple]) -> Counter:
    part = []
    for i, v, label in rows:
        if label is not None and sound(v):
            label = (label + 1) % 10 if i is not None and math.fmod(i, 7) == 0 else label
            part.append((i, label, [math.floor(256 * x) for x in v]))
    size = max((len(q) for _, _, q in part), default=0)
    q = np.array([[*q, *[0] * (size - len(q))] for _, _, q in part], np.int64).reshape(len(part), size)
    out: Counter = Counter()
    for a, (i, label, _) in enumerate(part):
        if i is None or i % 50:
            continue
        scores = q @ q[a]
        order = sorted((k for k in range(len(part)) if k != a), key=lambda k: (-scores[k], part[k][0] is None, part[k][0]))
        for p in [k for k in order if part[k][1] == label][:5]:
            fit = [k for k in order if part[k][1] != label and 50 * scores[p] <= 100 * scores[k] <= 95 * scores[p]]
            for rank, k in enumerate(fit[:3], 1):
                out[(i, part[p][0], rank, part[k][0], int(scores[p]), int(scores[k]))] += 1
    return out


def mined(spark, rows: list[tuple], **shape: int) -> Counter:
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(tuple(r) for r in negatives.mined(frame(spark, rows), **shape).select(*columns).collect())


def test_hard_negatives_equal_brute_force(spark, vectors):
    want = hard_negatives(vectors)
    assert len(want) > 100
    assert mined(spark, vectors) == want


def test_hard_negatives_on_many_small_shelves(spark, vectors, monkeypatch):
    monkeypatch.setattr(negatives, "ATLAS", 5)
    rows = [r for r in vectors if r[0] is None or r[0] < 400 or r[0] > 1150]
    assert mined(spark, rows, block=8, blocks=2) == hard_negatives(rows)


def test_hard_negatives_of_repeated_short_and_few_rows(spark):
    few = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (50, [1.0], 1), (1, [0.8, 1.0, 0.1], 2), (2, [], 3), (3, [0.7, 1.0], 2)]
    assert mined(spark, few) == hard_negatives(few)
    assert mined(spark, []) == Counter()
    with pytest.raises(Exception, match="exact 64-bit product"):
        mined(spark, [(0, [3e30], 1), (1, [1.0], 1)])


def test_zone_maps_leave_out_shelves(spark):
    """Two far clusters on few components: anchors do not ask for the other one's shelves."""
    rng = np.random.default_rng(1)
    rows = [(i, [(1 if i % 2 else -1) + rng.random() * 0.01, rng.random() * 0.01], i % 4) for i in range(4000)]
    part = negatives.prepared(frame(spark, rows))
    low, high, size = negatives.grid(part)
    shape = negatives.Shape(size, 16, 4)
    shelves = negatives.staged(negatives.shelved(part, low, high, shape))
    packs = negatives.staged(negatives.packs_of(shelves, shape))
    own = packs.selectExpr("shelf as pack", "shelf")
    home = negatives.best(negatives.searched(shelves, packs, own, shape, True, 5), 5)
    raised = negatives.refilled(packs, home, shape, False, 5)
    wanted = negatives.wanted_shelves(raised, shelves.select("shelf", "low", "high"), 1, shape)
    n, asked = shelves.count(), wanted.count()
    assert n > 1 and asked < n * (n - 1)


@pytest.mark.parametrize(("size", "bits"), [(2, 3), (3, 2), (1, 4), (5, 2)])
def test_hilbert_curve_visits_neighbours(size, bits):
    cells = np.indices((1 << bits,) * size).reshape(size, -1).T
    keys = negatives.hilbert_keys(cells, bits)
    order = sorted(range(len(cells)), key=lambda k: keys[k].tobytes())
    assert len({k.tobytes() for k in keys}) == len(cells)
    steps = np.abs(np.diff(cells[order], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def clusters(rows: list[tuple], count: int = 16, rounds: int = 3) -> Counter:
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v, _ in rows if sound(v) and len(v) == 64]
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None)
    middle = [list(q) for _, q in named[:count]]
    if not middle:
        return Counter((i, None, None, None, None, None) for i, _ in kept)

    def place() -> list[tuple[int, int]]:
        return [min((sum((a - b) ** 2 for a, b in zip(q, m, strict=True)), c) for c, m in enumerate(middle)) for _, q in kept]

    for _ in range(rounds):
        at = place()
        for c in range(len(middle)):
            own = [q for (_, q), (_, k) in zip(kept, at, strict=True) if k == c]
            if own:
                middle[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    at = place()
    total = Counter()
    for d, c in at:
        total[c] += d
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in middle]
    return Counter(
        (i, c, d, total[c], sum(total.values()), digest[c]) for (i, _), (d, c) in zip(kept, at, strict=True)
    )


@pytest.mark.parametrize("take", [slice(None), slice(0, 5), slice(690, 720)])
def test_clusters_equal_brute_force(spark, vectors, take):
    rows = vectors[take] + vectors[-4:]
    rows += [(2000, [1.0] * 63, 1), (2001, [], 1), (3, vectors[3][1], 1)]
    assert Counter(tuple(r) for r in centroids.clustered(frame(spark, rows)).collect()) == clusters(rows)


def test_clusters_without_ids_rows_or_range(spark, vectors):
    rows = [(None, vectors[0][1], 1), (4, None, 1)]
    assert Counter(tuple(r) for r in centroids.clustered(frame(spark, rows)).collect()) == clusters(rows)
    assert centroids.clustered(frame(spark, [])).count() == 0
    with pytest.raises(Exception, match="exact 64-bit product"):
        centroids.clustered(frame(spark, [(1, [3e30] * 64, 1)])).collect()


def test_search_is_exact_and_leaves_centroids_out():
    rng = np.random.default_rng(3)
    for scale in (3, 1000, 1 << 26):
        values = rng.integers(-scale, scale + 1, (200, 64))
        values[50:60] = values[40:50]
        vectors = np.concatenate((rng.integers(-scale, scale + 1, (300, 64)), values[::5]))
        cluster, distance = centroids.Centroids(values).nearest(vectors)
        whole = ((vectors[:, None] - values) ** 2).sum(axis=2)
        assert (cluster == whole.argmin(axis=1)).all() and (distance == whole.min(axis=1)).all()
