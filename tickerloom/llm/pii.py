"""Operator 8, PII: an Aho-Corasick automaton finds anchors, local parsers expand them.

Anchors are at-signs, plus signs, digits, schemes and identifier cues. Each anchor is
expanded by a deterministic parser that looks only at the run of characters around it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Kinds in the order of a digest: the four base kinds, then those the method adds.
BASE = ("email", "ip", "card", "phone")
ADDED = ("url", "iban", "account", "secret")
KINDS = BASE + ADDED
MASKS = {k: f"<{k.upper()}>" for k in KINDS}

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"[0-9][ ().0-9-]+")
_URL = re.compile(r"[^\s<>\"'`|]+")
_AUTHORITY = re.compile(r"[^\s<>\"'`|/]+")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_ACCOUNT = re.compile(
    r"[ \t]*(?:number|no\.?|nr\.?|id)?[ \t]*[:=#]?[ \t]*([A-Za-z]{0,3}-?[0-9][0-9A-Za-z-]{4,33})", re.I
)
_SECRET = re.compile(r"[\"']?[ \t]*[:=][ \t]*[\"']?([A-Za-z0-9_+/=.~-]{8,512})")
_KEY_BLOCK = re.compile(r"[A-Z ]{0,40}PRIVATE KEY-----")
#: Words after which an identifier or a secret follows, lower case.
CUES = ("account", "acct", "ssn", "passport", "tax id", "customer id", "member id")
SECRET_CUES = ("token", "secret", "password", "passwd", "api_key", "api-key", "apikey", "access_key")
_LOWER = {c: c + 32 for c in range(65, 91)}


def _automaton() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for i in range(10):
        out.add_word(str(i), "digit")
    out.add_word("@", "at")
    out.add_word("+", "plus")
    out.add_word("://", "scheme")
    for cue in CUES:
        out.add_word(cue, "cue")
    for cue in SECRET_CUES:
        out.add_word(cue, "secret")
    out.add_word("-----begin ", "block")
    out.make_automaton()
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    moved = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


class Finder:
    """Finds spans in texts; `find` returns ``(kind, start, end)`` in code points.

    Within a kind spans do not overlap and the leftmost one stands. A match that a
    check refuses is dropped, and the search goes on behind it.
    """

    def __init__(self) -> None:
        self._anchors = _automaton()

    def find(self, text: str) -> list[tuple[str, int, int]]:
        done = dict.fromkeys(KINDS, 0)
        found: list[tuple[str, int, int]] = []
        run_end = -1
        # Cues are found in any case; lower-casing ASCII letters moves no position.
        for at, kind in self._anchors.iter(text.translate(_LOWER)):
            if kind == "digit":
                if at > run_end:
                    run_end = self._digits(text, at, done, found)
            elif kind == "at":
                self._email(text, at, done, found)
            elif kind == "plus":
                self._phone(text, at, found)
            elif kind == "scheme":
                self._url(text, at - 2, done, found)
            elif kind == "cue":
                self._account(text, at + 1, done, found)
            elif kind == "secret":
                self._secret(text, at + 1, done, found)
            else:
                self._key_block(text, at, done, found)
        order = {k: i for i, k in enumerate(KINDS)}
        return sorted(found, key=lambda s: (order[s[0]], s[1]))

    def _digits(self, text: str, at: int, done: dict, found: list) -> int:
        """Handle the run of digits that begins at `at`; its last position is returned."""
        end = at + 1
        while end < len(text) and "0" <= text[end] <= "9":
            end += 1
        if at >= done["ip"] and text[end : end + 1] == "." and (m := _IP.match(text, at)):
            done["ip"] = m.end()
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m[0].split("."))):
                found.append(("ip", at, m.end()))
        if at >= done["card"] and (m := _CARD.match(text, at)):
            done["card"] = m.end()
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", at, m.end()))
        if at >= done["iban"] and at >= 2 and end - at >= 2:
            self._iban(text, at - 2, done, found)
        return end - 1

    def _email(self, text: str, at: int, done: dict, found: list) -> None:
        start = at
        while start > done["email"] and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            done["email"] = m.end()
            found.append(("email", start, m.end()))

    def _phone(self, text: str, at: int, found: list) -> None:
        if m := _PHONE.match(text, at + 1):
            end = m.end()
            while not "0" <= text[end - 1] <= "9":
                end -= 1
            if end - at >= 4 and 9 <= sum("0" <= c <= "9" for c in text[at:end]) <= 15:
                found.append(("phone", at, end))

    def _url(self, text: str, at: int, done: dict, found: list) -> None:
        """An address that carries credentials: ``scheme://user:secret@host``."""
        start = at
        while start > done["url"] and text[start - 1].isascii() and text[start - 1].isalnum():
            start -= 1
        authority = _AUTHORITY.match(text, at + 3)
        if start == at or authority is None:
            return
        user, sign, host = authority[0].rpartition("@")
        if sign and ":" in user and host:
            whole = _URL.match(text, at + 3)[0].rstrip(".,;:!?)")
            done["url"] = at + 3 + len(whole)
            found.append(("url", start, done["url"]))

    def _iban(self, text: str, at: int, done: dict, found: list) -> None:
        if at < done["iban"] or (at and text[at - 1].isalnum()):
            return
        if m := _IBAN.match(text, at):
            plain = m[0].replace(" ", "")
            if 15 <= len(plain) <= 34 and iban_valid(plain):
                done["iban"] = m.end()
                found.append(("iban", at, m.end()))

    def _account(self, text: str, at: int, done: dict, found: list) -> None:
        if (m := _ACCOUNT.match(text, at)) and m.start(1) >= done["account"]:
            if sum(c.isdigit() for c in m[1]) >= 5:
                done["account"] = m.end(1)
                found.append(("account", m.start(1), m.end(1)))


    def _secret(self, text: str, at: int, done: dict, found: list) -> None:
        """The value given to a name like ``token``: letters and digits, eight characters or more."""
        if (m := _SECRET.match(text, at)) and m.start(1) >= done["secret"]:
            if any(c.isdigit() for c in m[1]) and any(c.isalpha() for c in m[1]):
                done["secret"] = m.end(1)
                found.append(("secret", m.start(1), m.end(1)))

    def _key_block(self, text: str, at: int, done: dict, found: list) -> None:
        """A private key from its first line to its last."""
        m = _KEY_BLOCK.match(text, at + 1)
        if m and at - 10 >= done["secret"] and m[0] not in done:
            end = text.find(f"-----END {m[0]}", m.end())
            if end < 0:
                # No later block of this name ends either.
                done[m[0]] = at
                return
            done["secret"] = end + len("-----END ") + len(m[0])
            found.append(("secret", at - 10, done["secret"]))


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """`text` with every span replaced by its kind; of overlapping spans the union goes."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], MASKS[kind]]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


SPANS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField(
            "spans",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("kind", T.StringType()),
                        T.StructField("start", T.LongType()),
                        T.StructField("end", T.LongType()),
                    ]
                )
            ),
        ),
    ]
)


def find_pii(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans)`` of every row.

    Null text reads as empty and has no spans. Repeated rows and null ids give one row
    each. Texts are read whole, one at a time; memory follows the longest text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            spans = [
                [{"kind": k, "start": s, "end": e} for k, s, e in finder.find(t.as_py() or "")]
                for t in batch.column("text")
            ]
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(spans, kind)], names=["doc_id", "spans"]
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, SPANS)


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with personal data in ``text`` replaced by its kind; null text stays null."""
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        for batch in batches:
            texts = [
                None if (t := v.as_py()) is None else mask(t, finder.find(t))
                for v in batch.column(at)
            ]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.column(at).type))

    return docs.mapInArrow(run, docs.schema)


def digest(spans: list[dict], kinds: tuple[str, ...] = KINDS) -> str:
    return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans if s["kind"] in kinds)


def pii_digests(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans as text."""
    found = find_pii(docs)
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    text = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
        F.size("spans").cast("bigint").alias("n_spans"),
    )
