"""Operator 4, chat formatting: a state machine over roles and a declared template."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ESCAPE = "\x1b"


@dataclass(frozen=True)
class Frame:
    """What stands before and after a turn's text, and whether the text is trained on."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Frames by role, the frame of any other role, and the allowed turn order.

    An unknown role's name stands in the text, between ``other.before`` and `named`.
    """

    roles: dict[str, Frame] = field(
        default_factory=lambda: {
            "system": Frame("<<SYS>>", "<</SYS>>"),
            "user": Frame("[INST]", "[/INST]"),
            "assistant": Frame("[ANS]", "</s>", True),
        }
    )
    other: Frame = Frame("<<ROLE>>", "<</ROLE>>")
    named: str = "<<TEXT>>"
    #: State after each role that may follow a state; the start state is the empty text.
    order: frozenset[tuple[str, str]] = frozenset(
        {("", "system"), ("", "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user")}
    )
    final: frozenset[str] = frozenset({"assistant"})

    def controls(self) -> list[str]:
        frames = [*self.roles.values(), self.other]
        return [self.named, *(f.before for f in frames), *(f.after for f in frames)]


class Formatter:
    """Formats single turns and reads them back; checks that the template is readable."""

    def __init__(self, template: Template) -> None:
        self.template = template
        controls = template.controls()
        if len(set(controls)) < len(controls) or any(not c or ESCAPE in c for c in controls):
            raise ValueError("control strings must differ, must not be empty or hold the escape")
        for a in controls:
            for b in controls:
                inside = a != b and a in b
                if inside or any(a[-n:] == b[:n] for n in range(1, min(len(a), len(b)))):
                    raise ValueError(f"control strings {a!r} and {b!r} overlap")
        self._control = re.compile("|".join(map(re.escape, controls)))
        self._roles = {f.before: r for r, f in template.roles.items()}

    def escape(self, text: str) -> str:
        text = text.replace(ESCAPE, ESCAPE + "0")
        return self._control.sub(lambda m: m[0][0] + ESCAPE + "1" + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return text.replace(ESCAPE + "1", "").replace(ESCAPE + "0", ESCAPE)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """The turn as ``(text, loss)`` pieces."""
        frame = self.template.roles.get(role)
        if frame is None:
            other = self.template.other
            head = other.before + self.escape(role) + self.template.named
            return [(head, False), (self.escape(text), other.loss), (other.after, False)]
        return [(frame.before, False), (self.escape(text), frame.loss), (frame.after, False)]

    def read(self, formatted: str) -> list[tuple[str, str]]:
        """``(role, text)`` of every turn in a formatted text."""
        out, at, role, parts = [], 0, None, []
        for m in self._control.finditer(formatted):
            parts.append(self.unescape(formatted[at : m.start()]))
            at = m.end()
            if role is None:
                role, parts = self._roles.get(m[0], ""), []
                known = m[0] in self._roles
            elif m[0] != self.template.named:
                out.append((role, parts[0]) if known else (parts[0], parts[1]))
                role = None
        return out

    def step(self, state: str, role: str) -> tuple[str, bool]:
        """The next state, and whether the turn order allows it."""
        return role, (state, role) in self.template.order


TURNS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("position", T.LongType()),
        T.StructField("in_order", T.BooleanType()),
        T.StructField("formatted", T.StringType()),
        T.StructField(
            "segments",
            T.ArrayType(
                T.StructType(
                    [T.StructField("text", T.StringType()), T.StructField("loss", T.BooleanType())]
                )
            ),
        ),
    ]
)
_SEGMENTS = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))


def format_chat(rows: DataFrame, template: Template | None = None) -> DataFrame:
    """One row per turn: its place, whether it is in order, its text and its segments.

    `rows` has conv_id, turn, role, text. Null text reads as empty, a null role as a role
    without a name, null turns come first; equal turns are ordered by role, then text.
    Repeated rows are turns of their own. Conversations with a null id are one.

    A conversation is streamed in turn order: the state is one role and one counter, so
    a conversation of any length takes constant memory. It stays in one task, since the
    place and the state of a turn follow from all turns before it.
    """
    formatter = Formatter(template or Template())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, position, state = object(), 0, ""
        for batch in batches:
            ids = batch.column("conv_id").to_pylist()
            columns: list[list] = [[], [], [], []]
            for conv, role, text in zip(
                ids, batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True
            ):
                if conv != current:
                    current, position, state = conv, 0, ""
                state, fits = formatter.step(state, role or "")
                parts = formatter.segments(role or "", text or "")
                for column, value in zip(
                    columns,
                    (
                        position,
                        fits,
                        "".join(p for p, _ in parts),
                        [{"text": p, "loss": flag} for p, flag in parts],
                    ),
                    strict=True,
                ):
                    column.append(value)
                position += 1
            yield pa.record_batch(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.bool_()),
                    pa.array(columns[2], pa.string()),
                    pa.array(columns[3], _SEGMENTS),
                ],
                names=TURNS.names,
            )

    return (
        rows.select(F.col("conv_id").cast("bigint"), F.col("turn"), "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInArrow(run, TURNS)
    )


def chat_digests(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """Per conversation: digests of what `turns` says when it is read back."""
    template = template or Template()
    formatter = Formatter(template)
    schema = (
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint, valid boolean"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, out = object(), []
        totals, role, last = [0, 0, 0, True], hashlib.sha256(), ""
        loss = hashlib.sha256()

        def close() -> None:
            if totals[0]:
                valid = totals[3] and last in template.final
                out.append(
                    (current, totals[0], role.hexdigest(), totals[1], loss.hexdigest(), totals[2], valid)
                )

        def flush() -> pa.RecordBatch:
            table = list(zip(*out, strict=True)) if out else [[] for _ in range(7)]
            out.clear()
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
            return pa.record_batch(
                [pa.array(list(c), k) for c, k in zip(table, kinds, strict=True)],
                names=[c.split()[0] for c in schema.split(", ")],
            )

        for batch in batches:
            for row in batch.to_pylist():
                if row["conv_id"] != current:
                    close()
                    current, totals = row["conv_id"], [0, 0, 0, True]
                    role, loss = hashlib.sha256(), hashlib.sha256()
                for name, text in formatter.read(row["formatted"]):
                    totals[0] += 1
                    role.update(f"{name}\n{text}\n".encode())
                    last = name
                for part in row["segments"]:
                    if part["loss"]:
                        text = formatter.unescape(part["text"])
                        totals[1] += len(text)
                        loss.update(text.encode())
                totals[2] += len(row["formatted"])
                totals[3] &= row["in_order"]
            yield flush()
        close()
        yield flush()

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "position")
    return ordered.mapInArrow(run, schema)
