"""Operator 13 against brute force, and the covering property of its anchors."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from tickerloom.llm import simhash


def fingerprint(text: str | None) -> int:
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [words[k : k + 4] for k in range(len(words) - 3)] or ([words] if words else [])
    hashes = [xxhash.xxh64(" ".join(s).encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints: list[int], ids: list[int | None]) -> list[int | None]:
    parent = list(range(len(prints)))

    def top(k: int) -> int:
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                parent[top(a)] = top(b)
    least: dict[int, int] = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    return [least.get(top(k)) for k in range(len(ids))]


def test_documents_equal_brute_force(spark, documents, texts):
    prints = [fingerprint(t) for _, t in texts]
    want = Counter(zip([i for i, _ in texts], [f"{p:016x}" for p in prints], components(prints, [i for i, _ in texts]), strict=True))
    assert Counter(tuple(r) for r in simhash.linked(documents).collect()) == want


def test_empty_table(no_documents):
    assert simhash.linked(no_documents).count() == 0


def test_long_texts_are_hashed_in_lots(monkeypatch):
    monkeypatch.setattr(simhash, "LOT", 7)
    text = " ".join(f"W{k * k % 91}" for k in range(500))
    assert simhash.fingerprint(text) == fingerprint(text)


def close_prints(n: int) -> list[int]:
    rng = random.Random(2)
    out = [rng.getrandbits(64) for _ in range(40)]
    while len(out) < n:
        p = rng.choice(out)
        for b in rng.sample(range(64), rng.randint(1, 6)):
            p ^= 1 << b
        out.append(p)
    return sorted(set(out))


@pytest.mark.parametrize("layout", [simhash.NARROW, simhash.WIDE])
def test_links_equal_brute_force(spark, layout, monkeypatch):
    monkeypatch.setattr(simhash, "SLICE", 3)
    prints = close_prints(300)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    pairs = simhash.linked_prints(spark.createDataFrame([(p,) for p in signed], "print bigint"), layout)
    labels = {r["v"]: r["label"] for r in simhash.components(pairs).collect()}
    want = components(prints, signed)
    assert [labels.get(p, p) for p in signed] == want
    assert 40 < len(set(want)) < 300


@pytest.mark.parametrize("layout", [simhash.NARROW, simhash.WIDE])
def test_every_close_pair_meets_at_an_anchor(layout):
    rng = random.Random(3)
    a = np.array([rng.getrandbits(64) for _ in range(400)], np.uint64)
    b = a.copy()
    for k in range(len(b)):
        for bit in rng.sample(range(64), 4):
            b[k] ^= np.uint64(1 << bit)
    met = np.zeros(len(a), bool)
    for block in layout:
        row, anchor, home = block.anchors(a)
        assert (np.bincount(row[home], minlength=len(a)) == 1).all()
        homes = dict(zip(row[home].tolist(), anchor[home].tolist(), strict=True))
        visits = set(zip(*(x.tolist() for x in block.anchors(b)[:2]), strict=True))
        met |= np.array([(k, homes[k]) in visits for k in range(len(a))])
    assert met.all()


def test_layout_must_cover_the_difference(documents):
    with pytest.raises(ValueError, match="thresholds"):
        simhash.linked(documents, differ=5, layout=simhash.NARROW)
