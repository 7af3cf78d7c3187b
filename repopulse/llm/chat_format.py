"""Chat formatting: a finite-state machine over roles and a declarative template.

Turns are dealt out by conversation and sorted on disk; each task then streams over them with the
state of one conversation in hand, so no conversation has to fit into memory. A conversation is
read by one task, because its order and its digests run through all its turns.

Every turn becomes one row with its text segments and their loss flags. Text that looks like a
control string is broken up by the escape character and can be restored exactly.

Null texts and roles count as empty; a null conversation or turn is a value like any other and
sorts first. Turns of equal number are taken in order of role, then text. Roles unknown to the
template are written with their name, carry no loss and make the order invalid. Extra columns are dropped.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Part:
    """How a turn of one role is written, and whether its text is trained on."""

    begin: str
    end: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """``parts`` by role, ``other`` for any other role, and the machine over roles.

    ``follows`` has the states' transitions: the state is the role of the last turn, "" at the start.
    """

    parts: dict[str, Part]
    other: Part
    follows: dict[str, tuple[str, ...]]
    ends: tuple[str, ...]
    escape: str = "\\"
    name_end: str = "\n"
    controls: tuple[str, ...] = field(default=())

    def control_strings(self) -> list[str]:
        marks = {m.strip() for part in (*self.parts.values(), self.other) for m in (part.begin, part.end)}
        return sorted(marks | set(self.controls), key=lambda m: (-len(m), m))


TEMPLATE = Template(
    parts={
        "system": Part("<<SYS>>\n", "\n<</SYS>>\n"),
        "user": Part("[INST] ", " [/INST]\n"),
        "assistant": Part("<s> ", " </s>\n", loss=True),
    },
    other=Part("[ROLE] ", " [/ROLE]\n"),
    follows={"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    ends=("assistant",),
)

SEGMENTS = "array<struct<text:string,loss:boolean>>"
FORMATTED = (
    f"conv_id bigint, position bigint, turn bigint, segments {SEGMENTS}, state string, in_order boolean, can_end boolean"
)
DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint, valid boolean"
)
FORMATTED_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("position", pa.int64()),
        ("turn", pa.int64()),
        ("segments", pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))),
        ("state", pa.string()),
        ("in_order", pa.bool_()),
        ("can_end", pa.bool_()),
    ]
)
DIGESTS_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("valid", pa.bool_()),
    ]
)


def _rows(batches: Iterator[pa.RecordBatch], most: int = 512) -> Iterator[list[dict]]:
    """The rows of each batch, a few at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, most):
            yield batch.slice(start, most).to_pylist()


class Writer:
    """Escapes texts and writes turns by a template."""

    def __init__(self, template: Template) -> None:
        self.template = template
        mark = re.escape(template.escape)
        if any(c[1:2] == "n" or template.escape in c for c in template.control_strings()):
            raise ValueError("control strings may not hold the escape character or have n as their second character")
        self._risky = re.compile("|".join([mark, *map(re.escape, template.control_strings())]))
        self._escaped = re.compile(f"{mark}(.?)", re.DOTALL)

    def escape(self, text: str) -> str:
        """Double the escape character, and put one behind the first character of every control string."""
        mark = self.template.escape
        return self._risky.sub(lambda m: mark * 2 if m[0] == mark else m[0][0] + mark + m[0][1:], text)

    def unescape(self, text: str) -> str:
        """A doubled escape character is one; a single one goes and what follows it stays."""
        return self._escaped.sub(lambda m: m[1], text)

    def segments(self, role: str, text: str) -> list[dict]:
        part = self.template.parts.get(role)
        if part is None:
            part = self.template.other
            begin = part.begin + self.escape(role).replace(self.template.name_end, self.template.escape + "n") + self.template.name_end
        else:
            begin = part.begin
        pieces = ((begin, False), (self.escape(text), part.loss), (part.end, False))
        return [{"text": piece, "loss": loss} for piece, loss in pieces]

    def read(self, written: str) -> tuple[str, str]:
        """Role and text of one written turn."""
        for role, part in self.template.parts.items():
            if written.startswith(part.begin) and written.endswith(part.end):
                return role, self.unescape(written[len(part.begin) : len(written) - len(part.end)])
        part = self.template.other
        if not (written.startswith(part.begin) and written.endswith(part.end)):
            raise ValueError("a turn is not marked as the template says")
        name, _, body = written[len(part.begin) : len(written) - len(part.end)].partition(self.template.name_end)
        # No control string has n as its second character, so this pair can only be a line feed.
        name = self._escaped.sub(lambda m: self.template.name_end if m[1] == "n" else m[1], name)
        return name, self.unescape(body)


def _streamed(turns: DataFrame) -> DataFrame:
    """Whole conversations in the same task, in order."""
    order = ["conv_id", "turn", "role", "text"]
    return (
        turns.select(
            F.col("conv_id").cast("bigint").alias("conv_id"),
            F.col("turn").cast("bigint").alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions(*order)
    )


def format_turns(turns: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """One row per turn of (conv_id, turn, role, text): its segments with loss flags and the machine's state.

    in_order is false from the first turn on that may not follow; can_end tells whether a conversation may end here.
    Rows of a conversation stay together and in order within a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, current, state, good, position = Writer(template), object(), "", True, 0
        for rows in _rows(batches):
            out = []
            for row in rows:
                if row["conv_id"] != current:
                    current, state, good, position = row["conv_id"], "", True, 0
                good = good and row["role"] in template.follows.get(state, ())
                state = row["role"]
                out.append(
                    {
                        "conv_id": current,
                        "position": position,
                        "turn": row["turn"],
                        "segments": writer.segments(state, row["text"]),
                        "state": state,
                        "in_order": good,
                        "can_end": good and state in template.ends,
                    }
                )
                position += 1
            yield pa.RecordBatch.from_pylist(out, FORMATTED_ARROW)

    return _streamed(turns).mapInArrow(run, FORMATTED)


def read_back(formatted: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Digests of each conversation, from what format_turns wrote and in the same tasks.

    valid: all turns in order, and the last one may end a conversation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, current, held = Writer(template), object(), None

        def closed() -> dict:
            return {"conv_id": current} | {k: v.hexdigest() if k.endswith("sha256") else v for k, v in held.items()}

        for rows in _rows(batches):
            out = []
            for row in rows:
                if row["conv_id"] != current:
                    if held is not None:
                        out.append(closed())
                    current = row["conv_id"]
                    held = {"n_turns": 0, "turns_sha256": hashlib.sha256(), "loss_chars": 0}
                    held |= {"loss_sha256": hashlib.sha256(), "formatted_chars": 0, "valid": True}
                written = "".join(s["text"] for s in row["segments"])
                role, text = writer.read(written)
                trained = writer.unescape("".join(s["text"] for s in row["segments"] if s["loss"]))
                held["n_turns"] += 1
                held["turns_sha256"].update(f"{role}\n{text}\n".encode())
                held["loss_chars"] += len(trained)
                held["loss_sha256"].update(trained.encode())
                held["formatted_chars"] += len(written)
                held["valid"] = row["can_end"]
            yield pa.RecordBatch.from_pylist(out, DIGESTS_ARROW)
        if held is not None:
            yield pa.RecordBatch.from_pylist([closed()], DIGESTS_ARROW)

    return formatted.mapInArrow(run, DIGESTS)
