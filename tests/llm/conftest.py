from __future__ import annotations

import random

import pytest

ROWS = "doc_id bigint, text string, lang string, source string, n_chars bigint, chunk int, v string, spans string"


def invented(rng: random.Random, n: int) -> str:
    parts = ["ka", "lo", "mi", "ren", "tu", "sol", "vé", "dra", "pin", "os"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def texts() -> list[tuple[int | None, str | None]]:
    """Ids and texts: copies, near copies, shared passages, long, empty and null ones, repeated rows."""
    rng = random.Random(5)
    base = [invented(rng, rng.randint(30, 260)) for _ in range(24)]
    passage = invented(rng, 90)
    out: list[tuple[int | None, str | None]] = list(enumerate(base))
    out += [(100, base[3]), (101, base[3]), (102, base[3].upper()), (3, base[3])]
    for k in range(12):
        words = base[7].split(" ")
        words[(k * 17) % len(words)] = f"edit{k}"
        out.append((200 + k, " ".join(words)))
    out += [(300 + k, f"{invented(rng, 20)} {passage}\n{invented(rng, 10)}") for k in range(4)]
    out += [(400, None), (401, ""), (402, " \n\t"), (403, "one"), (404, "one two"), (405, "one")]
    out += [(None, base[5]), (None, None), (500, "ab " * 3000), (501, "ab " * 400 + "tail")]
    out += [(502, invented(rng, 9000)), (503, "x" * 5000)]
    return out


@pytest.fixture
def documents(spark, texts):
    rows = [(i, t, None if k % 9 == 0 else "en", "a" if k % 3 else None, 0, k, "v", "s") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, ROWS).repartition(3)


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], ROWS)
