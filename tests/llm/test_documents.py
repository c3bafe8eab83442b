"""Operators over documents, against brute force; nulls, empty texts, ties and copies included."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tickerloom.llm import bpe, contamination, lm, pii, quality, similar, substrings, suffixes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def lower(text: str | None) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def rows(df) -> Counter:
    return Counter(tuple(r) for r in df.collect())


def test_lm_base_score_and_probability(documents, texts):
    got = lm.scored(documents, lm.Subwords(RANKS, public_tokenizers.PATTERN)).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    counts: Counter = Counter()
    for i, t in texts:
        if not held(i):
            counts.update(words(lower(t)))
            counts[None] += 1
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, t in texts:
        tokens = [*words(lower(t)), None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        want[(i, held(i), len(tokens), sum(counts[w] > 0 for w in tokens), n, round(base, 5))] += 1
    assert want == Counter((*r[:5], round(r[5], 5)) for r in got)
    assert all(r["score"] < 0 for r in got)


def test_lm_empty_table(no_documents):
    assert lm.scored(no_documents, lm.Subwords(RANKS, public_tokenizers.PATTERN)).count() == 0


def test_lm_windows_score_each_subword_once_and_causally():
    subwords = lm.Subwords(RANKS, public_tokenizers.PATTERN)
    pairs = np.random.default_rng(1).integers(0, 5, (subwords.size + 2,) * 2)
    model = lm.Model.of(pairs, subwords.begins_word())
    model.weights["out"] = np.random.default_rng(2).standard_normal(model.weights["out"].shape).astype(np.float32)
    ids = np.random.default_rng(3).integers(0, subwords.size, 3 * lm.BLOCK)
    inputs, place = ids.reshape(3, -1), np.arange(3)
    targets = np.roll(ids, -1).reshape(3, -1)
    found, _ = model.score(inputs, targets, place)
    assert len(found) == len(ids)
    changed = inputs.copy()
    changed[2, 5] = (changed[2, 5] + 1) % subwords.size
    again, _ = model.score(changed, targets, place)
    at = 2 * lm.BLOCK + 5
    assert np.allclose(found[:at], again[:at]) and not np.allclose(found[at:], again[at:])
    logits = model.forward(inputs[:2], np.array([False]))["logits"]
    total = np.exp(logits - np.log(np.exp(logits).sum(axis=1, keepdims=True)))
    last = inputs[1]
    inside = np.exp(model.inside[last])
    share = np.stack([np.bincount(model.class_of, weights=i, minlength=lm.CLASSES) for i in inside])
    assert np.allclose((total * share).sum(axis=1), 1, atol=1e-3)


def test_lm_packs_hold_every_text_and_rounds_every_block_once(documents, texts):
    subwords = lm.Subwords(RANKS, public_tokenizers.PATTERN)
    rows = documents.select("doc_id", "text").withColumn("held_out", lm.held_out())
    got, want = Counter(), Counter()
    key = lambda i, g, first: tuple(np.concatenate((i, g, [first])).tolist())
    packed = lm.packs(rows, subwords).select("held", *lm._TOKENS).toArrow()
    for t, learn in lm._chunks(packed.to_batches()):
        for r in range(lm.ROUNDS):
            inputs, targets, place = t.blocks(subwords, learn[r :: lm.ROUNDS])
            got.update(key(i, g, p == 0) for i, g, p in zip(inputs, targets, place, strict=True))
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    data = [(t or "").encode() for i, t in texts if not held(i)]
    offsets = np.concatenate(([0], np.cumsum([len(d) for d in data])))
    t = lm.Tokens.read(np.frombuffer(b"".join(data), np.uint8), offsets, subwords)
    want.update(key(i, g, p == 0) for i, g, p in zip(*t.blocks(subwords, np.arange(len(data))), strict=True))
    assert got == want


def test_lm_packs_keep_word_numbers_over_16_bits():
    subwords = lm.Subwords(RANKS, public_tokenizers.PATTERN)
    text = " ".join(f"w{i}" for i in range(70_000)).encode()
    t = lm.Tokens.read(np.frombuffer(text, np.uint8), np.array([0, len(text)]), subwords)
    again = lm.Tokens.unpacked(*t.packed())
    assert t.of.max() > 0xFFFF and np.array_equal(t.of, again.of)
    for a, b in zip(t.blocks(subwords, np.array([0])), again.blocks(subwords, np.array([0])), strict=True):
        assert np.array_equal(a, b)


def test_lm_gradients_and_training():
    subwords = lm.Subwords(RANKS, public_tokenizers.PATTERN)
    rng = np.random.default_rng(4)
    model = lm.Model.of(np.ones((subwords.size + 2,) * 2, np.int64), subwords.begins_word())
    ids = np.tile(rng.integers(0, 200, 40), 2000)[: 3200 * lm.BLOCK].reshape(-1, lm.BLOCK)
    targets = np.roll(ids.ravel(), -1).reshape(ids.shape)
    place, state = np.arange(len(ids)), lm.Adam()
    loss = lambda: -model.score(ids, targets, place)[0].mean()
    start = loss()
    for _ in range(6):
        model.train(ids, targets, place, state)
    assert loss() < 0.7 * start
    wide = {n: w.astype(np.float64) for n, w in model.weights.items()}
    model.weights, model.prior = wide, model.prior.astype(np.float64)
    first = np.array([False, True, False, False])

    def mean() -> float:
        out = model.forward(ids[:5], first)["logits"]
        picked = out[np.arange(out.shape[0]), model.class_of[targets[1:5].ravel()]]
        return float((np.log(np.exp(out).sum(axis=1)) - picked).mean())

    grads = model.gradients(ids[:5], targets[1:5], first)
    some = int(ids[2, 3])
    model.weights["embed"][some, 2] += 1e-4
    up = mean()
    model.weights["embed"][some, 2] -= 2e-4
    down = mean()
    model.weights["embed"][some, 2] += 1e-4
    assert grads["embed"][some, 2] == pytest.approx((up - down) / 2e-4, rel=1e-2, abs=1e-5)
    for name in ("query", "key", "value", "mix", "out", "place"):
        model.weights[name][1, 2] += 1e-4
        up = mean()
        model.weights[name][1, 2] -= 2e-4
        down = mean()
        model.weights[name][1, 2] += 1e-4
        assert grads[name][1, 2] == pytest.approx((up - down) / 2e-4, rel=1e-2, abs=1e-5)


@pytest.fixture
def benchmark(spark, texts):
    by_id = dict(texts)
    items = [
        (7, " ".join(words(by_id[300])[20:60]).upper()),
        (8, "one"),
        (9, None),
        (10, " ... "),
        (11, " ".join(words(by_id[2])[3:20])),
        (11, "one two"),
        (12, " ".join(words(by_id[500])[:14])),
    ]
    return spark.createDataFrame(items, "item_id bigint, text string")


def brute_contamination(texts, items) -> Counter:
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    phrases: dict[tuple, set] = {}
    for i, t in items:
        w = pattern.findall(lower(t))
        size = min(13, len(w))
        for j in range(len(w) - size + 1 if size else 0):
            phrases.setdefault(tuple(w[j : j + size]), set()).add(i)
    want = Counter()
    for i, t in texts:
        w, found, hit = pattern.findall(lower(t)), set(), set()
        for size in {len(p) for p in phrases}:
            for j in range(len(w) - size + 1):
                if (p := tuple(w[j : j + size])) in phrases:
                    found |= phrases[p]
                    hit.update(range(j, j + size))
        names = ",".join(sorted(map(str, found)))
        want[(i, len(w), len(hit), len(found), sha(names), bool(hit) and 20 * len(hit) >= len(w))] += 1
    return want


def test_contamination(documents, texts, benchmark, monkeypatch):
    want = brute_contamination(texts, [tuple(r) for r in benchmark.collect()])
    assert rows(contamination.judged(documents, benchmark)) == want
    kept = contamination.decontaminate(documents, benchmark)
    assert kept.columns == documents.columns
    assert kept.count() == sum(n for r, n in want.items() if not r[5])
    monkeypatch.setattr(contamination, "BLOCK_BYTES", 100)
    assert rows(contamination.judged(documents, benchmark)) == want


def test_contamination_empty(documents, no_documents, benchmark):
    assert contamination.judged(no_documents, benchmark).count() == 0
    assert not contamination.judged(documents, benchmark.where("false")).where("n_hit > 0").count()


def brute_components(texts, width: int, percent: int) -> Counter:
    sets = []
    for _, t in texts:
        w = words(lower(t))
        sets.append({tuple(w[j : j + width]) for j in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    label = list(range(len(sets)))
    changed = True
    links = [
        (a, b)
        for a in range(len(sets))
        for b in range(a)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    while changed:
        changed = False
        for a, b in links:
            if label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    least: dict[int, list] = {}
    for k, x in enumerate(label):
        least.setdefault(x, []).append(texts[k][0])
    return Counter(
        (i, len(sets[k]), min((d for d in least[label[k]] if d is not None), default=None))
        for k, (i, _) in enumerate(texts)
    )


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_similar(documents, texts, width, percent):
    got = similar.linked(documents, width, percent).select("doc_id", "n", "component_id")
    assert rows(got) == brute_components(texts, width, percent)


def test_similar_keeps_one_of_each(documents, texts):
    kept = similar.keep_one(documents)
    assert kept.columns == documents.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[3] == 1 and not ids[100] and not ids[101]
    assert all(ids[i] for i in (400, 401, 402)) and ids[403] == 1 and not ids[405]
    want = brute_components(texts, 3, 90)
    filled = {c for (i, n, c), _ in want.items() if n and c is not None}
    assert sum(ids.values()) == len(filled) + sum(k for (i, n, c), k in want.items() if not n)


def test_similar_empty(no_documents):
    assert similar.linked(no_documents).count() == 0
    assert similar.keep_one(no_documents).count() == 0


def test_bpe(documents, texts):
    ranks = bpe.read_ranks(RANKS)
    same = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for i, t in texts:
        ids = same.encode_ordinary(t or "")
        want[(i, len(ids), sha(" ".join(map(str, ids))), sha(t or ""))] += 1
    assert rows(bpe.bpe_digests(documents, ranks, public_tokenizers.PATTERN)) == want
    back = bpe.decode(bpe.encode(documents, ranks, public_tokenizers.PATTERN), ranks)
    assert Counter(r["text"] for r in back.collect()) == Counter(t or "" for _, t in texts)


def test_bpe_transducer_against_the_merges():
    ranks = bpe.read_ranks(RANKS)
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN, max_pieces=50)
    encoder._fst._max = 60
    same = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = np.random.default_rng(6)
    for alphabet in ("ab", "aA ", "the quick", "éüñ ß€😀", "0123 ", " \n\t ", "'s't re", "!?.,-"):
        for _ in range(150):
            text = "".join(rng.choice(list(alphabet), rng.integers(0, 40)))
            assert encoder.encode(text).tolist() == same.encode_ordinary(text)


def test_utf8_machine():
    data = "aé€😀z".encode() * 3
    for step in (1, 2, 3, 5):
        state = bpe.Utf8()
        out = [state.feed(data[k : k + step]) for k in range(0, len(data), step)]
        assert "".join(out) + state.close() == data.decode()
    state = bpe.Utf8()
    assert state.feed(b"a\xff\xe2\x82") + state.close() == "a��"


def test_substrings(documents, texts):
    infinite = float("inf")
    first: dict[tuple, float] = {}
    for i, t in texts:
        w = words(t)
        for j in range(len(w) - 49):
            key = tuple(w[j : j + 50])
            first[key] = min(first.get(key, infinite), infinite if i is None else i)
    want = Counter()
    for i, t in texts:
        w = words(t)
        gone: set[int] = set()
        for j in range(len(w) - 49):
            if first[tuple(w[j : j + 50])] < (infinite if i is None else i):
                gone.update(range(j, j + 50))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        want[(i, len(w), len(gone), sha(kept))] += 1
    assert rows(substrings.dedup_digests(documents)) == want
    crowded = substrings.repeated_words(documents, max_cells_log2=4)
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], sha(r["kept_text"])) for r in crowded.collect()) == want


def test_substrings_empty(no_documents):
    assert substrings.dedup_digests(no_documents).count() == 0


def brute_bytes(texts, length: int) -> Counter:
    count: Counter = Counter()
    for _, t in texts:
        data = (t or "").encode()
        count.update(data[j : j + length] for j in range(len(data) - length + 1))
    want = Counter()
    for i, t in texts:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for j in range(len(data) - length + 1):
            if count[data[j : j + length]] > 1:
                gone[j : j + length] = b"\1" * length
        kept = bytes(x for x, y in zip(data, gone, strict=True) if not y)
        runs = len(bytes(gone).replace(b"\0", b" ").split())
        want[(i, len(data), sum(gone), runs, sha(kept))] += 1
    return want


def test_suffixes(documents, texts):
    assert rows(suffixes.dedup_digests(documents)) == brute_bytes(texts, 400)


def test_suffixes_short_overlaps(spark):
    rng = np.random.default_rng(8)
    base = "".join(rng.choice(list("abcdefgh "), 3000))
    cut = [base[:1500], base[1100:1501], base[1100:1499], base[200:601] + base[900:1400], "q" * 401, base[2600:] + base[:390]]
    some = list(enumerate([base[:2000] + "!" + base[2000:], *cut]))
    df = spark.createDataFrame(some, "doc_id bigint, text string")
    assert rows(suffixes.dedup_digests(df)) == brute_bytes(some, 400)


def test_suffixes_cut_copies(spark):
    """Strings that repeat right before different bytes or an end, in two texts only."""
    rng = random.Random(11)
    some = []
    for _ in range(1200):
        same = "".join(rng.choice("abcdefghij ") for _ in range(400 + rng.randrange(90)))
        for _ in range(2):
            behind = "".join(rng.choice("klmnop ") for _ in range(rng.randrange(3) * 60))
            some.append((len(some), same + behind))
    df = spark.createDataFrame(some, "doc_id bigint, text string").repartition(3)
    assert rows(suffixes.dedup_digests(df)) == brute_bytes(some, 400)


def test_suffixes_passages_of_over_50_words_go_from_400_bytes_on(spark):
    """A passage's number of words does not matter: 399 equal bytes stay, 400 go."""
    rng = random.Random(12)
    some, sizes = [], (330, 399, 400, 401, 460)
    for size in sizes:
        passage = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(size // 6 + 1))[:size]
        assert len(passage.split()) > 50
        for end in "<>":
            lead = "".join(rng.choices("klmnop ", k=300))
            some.append((len(some), f"{lead}{end}{passage}{end}{lead[::-1]}"))
    df = spark.createDataFrame(some, "doc_id bigint, text string").repartition(3)
    got = rows(suffixes.dedup_digests(df))
    assert got == brute_bytes(some, 400)
    removed = {r[0]: r[2] for r in got}
    assert [removed[i] for i in range(len(some))] == [size if size >= 400 else 0 for size in sizes for _ in "<>"]


def test_suffixes_empty(no_documents):
    assert suffixes.dedup_digests(no_documents).count() == 0


PRIVATE = [
    "mail a.b+c@x-y.example.org, or bad@host, @no.body; a@b.c@d.e and é@ü.de",
    "ip 10.0.0.255 256.1.1.1 1.2.3.4.5.6.7.8 00001.2.3.4",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112 4111  1111 1111 1111 123456789012345678901",
    "+49 (30) 123-4567 8. +1 2 ++12345678901 +1.2.3.4.5.6.7.8.9+4915112345678",
    "see https://user:secret@host.example/path, https://host.example/a@b:c and ://x",
    "IBAN DE89 3704 0044 0532 0130 00 or DE00370400440532013000; Account number: AB-1234567, account 1",
    "ok " * 200 + "x@y.zz",
]


def brute_private(text: str) -> list[tuple[str, int, int]]:
    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[ -]", "", m[0])
        if 13 <= len(digits) <= 19 and pii.luhn(digits):
            spans.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.findall("[0-9]", m[0])) <= 15:
            spans.append(("phone", *m.span()))
    return spans


def test_private_base_kinds():
    finder = pii.Finder()
    rng = np.random.default_rng(9)
    random_texts = ["".join(rng.choice(list("01256 .-+()@ab"), 60)) for _ in range(3000)]
    for text in [*PRIVATE, *random_texts, ""]:
        assert [s for s in finder.find(text) if s[0] in pii.BASE] == brute_private(text)


def test_private_added_kinds_and_mask():
    finder = pii.Finder()
    kinds = lambda t: [t[a:b] for k, a, b in finder.find(t) if k in pii.ADDED]
    assert kinds(PRIVATE[4]) == ["https://user:secret@host.example/path"]
    assert kinds(PRIVATE[5]) == ["DE89 3704 0044 0532 0130 00", "AB-1234567"]
    assert not kinds("The account was closed. A passport is a book with 32 pages.")
    assert pii.mask("to a@b.cc now", finder.find("to a@b.cc now")) == "to <EMAIL> now"


def test_private_digests(spark, documents, texts):
    some = [*enumerate(PRIVATE), (None, None), (1, PRIVATE[1])]
    df = spark.createDataFrame([(i, t, "x") for i, t in some], "doc_id bigint, text string, spans string")
    want = Counter()
    for i, t in some:
        spans = brute_private(t or "")
        counts = Counter(k for k, _, _ in spans)
        digest = sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans))
        want[(i, *(counts[k] for k in pii.BASE), digest)] += 1
    assert rows(pii.pii_digests(df).drop("spans", "n_spans")) == want
    masked = pii.redact(df)
    assert masked.columns == df.columns and masked.where("text is null").count() == 1
    assert not any("@x-y" in (r["text"] or "") for r in masked.collect())
    assert rows(pii.redact(documents).select("doc_id", "text")) == Counter(texts)


def test_quality_counts(documents, texts):
    got = quality.judged(documents)
    want = Counter()
    for i, t in texts:
        w, text = words(t), t or ""
        seen = Counter(tuple(w[j : j + 8]) for j in range(len(w) - 7))
        repeated: set[int] = set()
        for j in range(len(w) - 7):
            if seen[tuple(w[j : j + 8])] > 1:
                repeated.update(range(j, j + 8))
        lines = [x for x in text.split("\n") if words(x)]
        failed = len(w) < 20 or 100 * len(repeated) > 30 * len(w)
        symbols = sum(c in "#*$%&|<>" for c in text)
        want[(i, len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(repeated), failed)] += 1
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert rows(got.select(names)) == want
    assert not got.where("base_failed AND kept").count()
    assert quality.quality_filter(documents).columns == documents.columns
    assert quality.quality_filter(documents).count() == got.where("kept").count()


def test_quality_thresholds_adapt(spark):
    plain = "a few plain words of a text that is long enough to count as one for the rules here " * 1
    words_ = plain.split()
    rows_ = []
    for source, often in (("clean", 0), ("marked", 1)):
        for k in range(60):
            rotated = words_[k % 17 :] + words_[: k % 17] + [f"w{k}"]
            text = " ".join(f"{w} |" if often and j % 2 else w for j, w in enumerate(rotated))
            rows_.append((len(rows_), text, "en", source))
    rows_.append((900, " ".join(f"{w}%%%" for w in words_) + " z y x", "en", "clean"))
    rows_.append((901, " ".join(f"{w} |" if j % 2 else w for j, w in enumerate(words_)) + " z y x", "en", "marked"))
    df = spark.createDataFrame(rows_, "doc_id bigint, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality.judged(df).collect()}
    assert not kept.pop(900) and kept.pop(901) and all(kept.values())


def test_quality_limits_follow_the_group(spark):
    rng = random.Random(6)
    make = lambda n, size: [
        "".join(rng.choice("abcdefgh") for _ in range(size + rng.randrange(3))) for _ in range(n)
    ]
    rows_ = []
    for source, n in (("short", 60), ("long", 400)):
        for _ in range(60):
            w = make(n, 4)
            rows_.append((len(rows_), "\n".join(" ".join(w[k : k + 10]) for k in range(0, n, 10)), "en", source))
    for k in range(8):
        rows_.append((len(rows_), " ".join(make(60, 4)), "en", "few"))
    passage = make(40, 4)
    rows_.append((900, " ".join([*make(300, 4), *passage, *passage]), "en", "long"))
    rows_.append((901, " ".join([*make(60, 4), *passage[:10], *passage[:10]]), "en", "short"))
    rows_ += [(902, " ".join(make(60, 1)), "en", "short"), (903, " ".join(make(60, 1)), "en", "few")]
    df = spark.createDataFrame(rows_, "doc_id bigint, text string, lang string, source string")
    got = {r["doc_id"]: r for r in quality.judged(df).collect()}
    for name in ("symbols_per_word", "dup_line_share", "repeat_share", "word_length"):
        assert got[0][f"{name}_limit"] > got[60][f"{name}_limit"] > 0
    assert got[60]["repeat_share_limit"] < 0.3 and not got[900]["base_failed"]
    assert {i for i in got if not got[i]["kept"]} == {900, 902, 903}


def test_quality_empty(no_documents):
    assert quality.judged(no_documents).count() == 0
    assert quality.quality_filter(no_documents).count() == 0


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        ("Account Number: 12345678", "account"),
        ("account number 12345678", "account"),
        ("Tax ID: 12345678", "account"),
        ('token = "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda"', "secret"),
        ("API_KEY: abcd1234efgh", "secret"),
        ("x -----BEGIN RSA PRIVATE KEY-----\nMIIB\n-----END RSA PRIVATE KEY----- y", "secret"),
    ],
)
def test_pii_added_kinds(text, kind):
    assert [k for k, _, _ in pii.Finder().find(text) if k == kind] == [kind]


def test_pii_clean_texts_and_long_parts():
    finder = pii.Finder()
    assert finder.find("the account of 1999 says the token was lost; secret = maybe") == []
    zeros = "0" * 5000
    assert [k for k, _, _ in finder.find(f"{zeros}1.{zeros}2.{zeros}3.{zeros}4")] == ["ip"]
    assert finder.find(f"{zeros}1.{zeros}2.{zeros}3.{zeros}999") == []
    start = time.time()
    finder.find("-----BEGIN PRIVATE KEY-----" * 40_000)
    finder.find("token = " * 100_000)
    assert time.time() - start < 5


CLASHING = ("_hits", "_items", "_n_words", "_hits0", "_id", "_hash", "_text_hash", "hits", "n", "k", "g", "count", "v")


def test_stages_keep_columns_named_like_helpers(spark, texts):
    rows = [(i, t, *[f"{c}{k}" for c in CLASHING]) for k, (i, t) in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, " + ", ".join(f"{c} string" for c in CLASHING))
    items = spark.createDataFrame([(1, texts[11][1])], "item_id bigint, text string")
    for out in (contamination.decontaminate(docs, items), similar.keep_one(docs, 5, 80)):
        assert out.columns == docs.columns
        kept = {tuple(r) for r in out.collect()}
        assert kept and kept < set(rows)
