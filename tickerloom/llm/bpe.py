"""Operator 6, byte-level BPE: merges as a lazily determinised finite-state transducer.

A sequence of tokens is the encoding of its bytes exactly if each two neighbours are:
nothing merges across their seam. So the merges are a nondeterministic transducer that
guesses token after token along a trie, and checks each seam. A state of the
deterministic one is the set of guesses that are still possible; what all of them
share is emitted at once. The rest of an encoding is the encoding of the rest, so a state
need not remember what was emitted, and few states serve all words. States and moves
are made when a text first needs them.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.kernel import modest_batches, ragged

ROOT = 0
END = 256
NEVER = 1 << 60
#: Rows of one output batch.
ROWS = 256


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file in the tiktoken format."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class Transducer:
    """Encodes byte strings; `max_states` bounds memory, at the bound all states are dropped.

    So are the seams that were checked for them.
    """

    def __init__(self, ranks: dict[bytes, int], max_states: int = 160_000) -> None:
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self._max = max_states
        self._children: list[dict[int, int]] = [{}]
        self._token_at: list[int] = [-1]
        for token, rank in ranks.items():
            node = ROOT
            for b in token:
                step = self._children[node].get(b)
                if step is None:
                    step = self._children[node][b] = len(self._children)
                    self._children.append({})
                    self._token_at.append(-1)
                node = step
            self._token_at[node] = rank
        self._reset()

    def _reset(self) -> None:
        self._spines: dict[tuple[int, int], list[tuple[bytes, int]]] = {}
        self._seams: dict[tuple[int, int], bool] = {}
        self._ids = {(((), -1, ROOT),): 0}
        self._states: list[tuple] = [(((), -1, ROOT),)]
        #: By ``state << 9 | byte``: the next state, shifted likewise, and what is emitted.
        self._moves: dict[int, tuple[int, tuple[int, ...]]] = {}

    def _halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two parts whose merge made `token`."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(
                range(len(parts) - 1),
                key=lambda i: self.ranks.get(parts[i] + parts[i + 1], NEVER),
            )
            if parts[best] + parts[best + 1] not in self.ranks:
                return None
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def _spine(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """Parts along one edge of a token, each with the rank of the merge that uses it up."""
        if (token, side) not in self._spines:
            part, used, out = self.tokens[token], NEVER, []
            while True:
                out.append((part, used))
                halves = self._halves(part)
                if halves is None:
                    break
                part, used = halves[side], self.ranks[part]
            self._spines[token, side] = out
        return self._spines[token, side]

    def holds(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart when their bytes are encoded together.

        Of merges of one rank the leftmost goes first: the seam lies right of the left
        token's own merges, and left of those of the right token.
        """
        known = self._seams.get((left, right))
        if known is None:
            known = not any(
                (rank := self.ranks.get(a + b, NEVER)) < a_used and rank <= b_used and rank < NEVER
                for a, a_used in self._spine(left, 1)
                for b, b_used in self._spine(right, 0)
            )
            self._seams[left, right] = known
        return known

    def _move(self, key: int) -> tuple[int, tuple[int, ...]]:
        state, byte = self._states[key >> 9], key & 511
        if byte == END:
            move = (0, next(p for p, _, node in state if node == ROOT))
            self._moves[key] = move
            return move
        guesses = []
        for pending, last, node in state:
            child = self._children[node].get(byte)
            if child is None:
                continue
            if self._children[child]:
                guesses.append((pending, last, child))
            token = self._token_at[child]
            if token >= 0 and (last < 0 or self.holds(last, token)):
                guesses.append(((*pending, token), token, ROOT))
        first, *others = [p for p, _, _ in guesses]
        shared = len(first)
        for other in others:
            same = 0
            while same < shared and same < len(other) and other[same] == first[same]:
                same += 1
            shared = same
            if not shared:
                break
        after = [(p[shared:], last if len(p) > shared else -1, node) for p, last, node in guesses]
        after.sort()
        after = tuple(after)
        found = self._ids.setdefault(after, len(self._states))
        if found == len(self._states):
            self._states.append(after)
        move = self._moves[key] = (found << 9, first[:shared])
        return move

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self._states) > self._max:
            self._reset()
        out: list[int] = []
        if not piece:
            return out
        get, state = self._moves.get, 0
        for byte in piece:
            state, emitted = get(state | byte) or self._move(state | byte)
            if emitted:
                out += emitted
        out += (get(state | END) or self._move(state | END))[1]
        return out


class Utf8:
    """Incremental UTF-8 state machine: text of finished characters, the rest is kept.

    The state is how many bytes the open character still needs and what the next one may
    be. A byte that fits nowhere gives U+FFFD.
    """

    def __init__(self) -> None:
        self._open = b""

    @staticmethod
    def _tail(data: bytes) -> int:
        """Length of an unfinished, so far valid, character at the end."""
        for back in range(1, min(3, len(data)) + 1):
            b = data[-back]
            if b & 0xC0 == 0x80:
                continue
            need = 2 if 0xC2 <= b <= 0xDF else 3 if b & 0xF0 == 0xE0 else 4 if 0xF0 <= b <= 0xF4 else 1
            if need <= back:
                return 0
            low = {0xE0: 0xA0, 0xF0: 0x90}.get(b, 0x80)
            high = {0xED: 0x9F, 0xF4: 0x8F}.get(b, 0xBF)
            return back if back == 1 or low <= data[1 - back or len(data)] <= high else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self._open + data
        keep = self._tail(data)
        self._open = data[len(data) - keep :]
        return data[: len(data) - keep].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self._open = self._open, b""
        return rest.decode("utf-8", "replace")


class Encoder:
    """Encodes texts by pattern and transducer; caches the ids of pieces up to a bound."""

    def __init__(
        self, ranks: dict[bytes, int], pattern: str, max_pieces: int = 120_000, max_states: int = 160_000
    ) -> None:
        self._fst = Transducer(ranks, max_states)
        self._split = regex.compile(pattern).findall
        self._max = max_pieces
        self._known: dict[str, list[int]] = {}

    def encode(self, text: str) -> np.ndarray:
        if len(self._known) > self._max:
            self._known = {}
        known = self._known
        pieces = self._split(text)
        parts = list(map(known.get, pieces))
        if None in parts:
            for i, part in enumerate(parts):
                if part is None:
                    piece = pieces[i]
                    part = known.get(piece)
                    if part is None:
                        part = known[piece] = self._fst.encode(piece.encode())
                    parts[i] = part
        return np.fromiter(chain.from_iterable(parts), np.int32)


class Decoder:
    """Bytes and text of ids."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        tokens = {r: t for t, r in ranks.items()}
        parts = [tokens.get(r, b"") for r in range(max(tokens, default=-1) + 1)]
        self._lengths = np.array([len(p) for p in parts], np.int64)
        self._starts = np.cumsum(self._lengths) - self._lengths
        self._bytes = np.frombuffer(b"".join(parts), np.uint8)

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return self._bytes[ragged(self._starts[ids], self._lengths[ids])].tobytes()

    def decode(self, ids: np.ndarray, step: int = 1 << 14) -> Iterator[str]:
        """Finished text of each `step` ids, as a stream."""
        state = Utf8()
        for at in range(0, len(ids), step):
            yield state.feed(self.decode_bytes(ids[at : at + step]))
        if rest := state.close():
            yield rest


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, back: bool = False, share: int = 1
) -> DataFrame:
    """``(doc_id, ids)`` of every row; with `back` also the ``text`` they decode to.

    A worker keeps one `share`-th of the usual states and pieces, for jobs in which it holds
    other things too.

    Null text reads as empty and has no ids. Repeated rows and null ids give a row each.
    Texts are encoded whole; memory follows the longest text. The ranks travel with the
    tasks, their size is that of one vocabulary.
    """
    modest_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, decoder = worker_encoder(shared.value, pattern, share), Decoder(shared.value)
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                ids = [codec.encode(t.as_py() or "") for t in part.column("text")]
                offsets = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int32)
                flat = pa.array(np.concatenate(ids), pa.int32())
                columns = {
                    "doc_id": part.column("doc_id"),
                    "ids": pa.ListArray.from_arrays(pa.array(offsets), flat),
                }
                if back:
                    texts = ["".join(decoder.decode(i.astype(np.int64))) for i in ids]
                    columns["text"] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "doc_id bigint, ids array<int>" + ", text string" * back
    )


def decode(rows: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """`rows` of ``(doc_id, ids)`` with the ``text`` that the ids stand for; null ids are none.

    Text is made from the bytes as they come, by the incremental state machine; bytes
    that are no UTF-8 give U+FFFD in it, which the ids of a text never do.
    """
    shared = rows.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Decoder(shared.value)
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                texts = []
                for ids in part.column("ids"):
                    values = ids.values
                    numbers = np.empty(0, np.int64) if values is None else values.to_numpy().astype(np.int64)
                    texts.append("".join(codec.decode(numbers)))
                yield pa.record_batch(
                    [part.column("doc_id"), part.column("ids"), pa.array(texts, pa.string())],
                    names=["doc_id", "ids", "text"],
                )

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>, text string")


def bpe_digests(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, keep_ids: bool = False, share: int = 1
) -> DataFrame:
    """Number of ids, digest of the ids and digest of what they decode to."""
    back = encode(docs, ranks, pattern, True, share)
    return back.select(
        "doc_id",
        *(["ids"] if keep_ids else []),
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


_ENCODERS: dict[tuple[int, str, int], Encoder] = {}


def worker_encoder(ranks: dict[bytes, int], pattern: str, share: int = 1) -> Encoder:
    """The encoder of this Python worker; its states serve all tasks that run in it."""
    key = (hash(frozenset(ranks.items())), pattern, share)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(ranks, pattern, 120_000 // share, 160_000 // share)
    return _ENCODERS[key]
