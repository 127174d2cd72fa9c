"""Format conversations for training with a declarative template, and read them back.

A template names for each role the text before and after a turn, and whether a turn's own text is learned from. Roles it does not
know get the general marks, with the role's name inside. The strings of the template that steer a model never occur inside of a turn's text: one
backslash is put after their first character, one more than the text has there already, which reading takes out again.

A finite-state machine walks over the roles of a conversation and marks the first turn that is out of order. Every turn is
formatted either way.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks by role (before, after), roles whose text is learned, general marks, and the legal moves between roles.

    `moves` maps a state to the roles that may follow; the empty string is the start. A conversation
    may end after a role in `last`.
    """

    marks: dict = field(
        default_factory=lambda: {
            "system": ("<<SYS>>", "<</SYS>>"),
            "user": ("[INST]", "[/INST]"),
            "assistant": ("<s>", "</s>"),
        }
    )
    learned: tuple = ("assistant",)
    other: tuple = ("[ROLE=", "]", "[/ROLE]")
    null_role: str = "[NULL]"
    moves: dict = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    last: tuple = ("assistant",)

    def controls(self) -> list[str]:
        """Strings that must not occur inside of a text."""
        marks = [m for pair in self.marks.values() for m in pair]
        return sorted({*marks, self.other[0], self.other[2], self.null_role}, key=lambda m: (-len(m), m))


class Formatter:
    """Turns to segments (text, learned) and back."""

    def __init__(self, template: Template):
        self.template = template
        controls = template.controls()
        self.plain = re.compile("|".join(f"{re.escape(c[0])}(\\\\*){re.escape(c[1:])}" for c in controls))
        self.escaped = re.compile("|".join(f"{re.escape(c[0])}\\\\(\\\\*){re.escape(c[1:])}" for c in controls))
        self.opening = {pair[0]: role for role, pair in template.marks.items()}

    def escape(self, text: str) -> str:
        return self.plain.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return self.escaped.sub(lambda m: m[0][0] + m[0][2:], text)

    def segments(self, role: str | None, text: str) -> list[tuple[str, bool]]:
        """Mark, text and mark of a turn."""
        if role in self.template.marks:
            before, after = self.template.marks[role]
            return [(before, False), (self.escape(text), role in self.template.learned), (after, False)]
        first, end, after = self.template.other
        name = self.template.null_role if role is None else quote(role, safe="")
        return [(first + name + end, False), (self.escape(text), False), (after, False)]

    def turn(self, written: str) -> tuple[str | None, str, bool]:
        """Role, text and whether it is learned, from the formatted turn."""
        for before, role in self.opening.items():
            if written.startswith(before):
                after = self.template.marks[role][1]
                inner = self.unescape(written[len(before) : len(written) - len(after)])
                return role, inner, role in self.template.learned
        first, end, after = self.template.other
        if not written.startswith(first):
            raise ValueError("not a formatted turn")
        rest = written[len(first) : len(written) - len(after)]
        name, _, inner = rest.partition(end) if not rest.startswith(self.template.null_role) else (None, "", "")
        if name is None:
            return None, self.unescape(rest[len(self.template.null_role + end) :]), False
        return unquote(name), self.unescape(inner), False


SEGMENTS = "array<struct<text: string, learned: boolean>>"


def format_turns(
    turns: DataFrame,
    template: Template,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row for each turn, in order within a conversation and partition: conv_id, place (from 0), segments, in_order.

    A conversation's formatted text is its turns' segments, put together. in_order is false from the first turn on that the
    template's moves do not allow. Turns come by number, nulls first, then by role and text. A null text is empty; a null
    role, and one the template does not know, gets the general marks and is out of order. Rows with a null conversation are one
    conversation. Rows that repeat are turns each. Turns are handled one after the other, so a long
    conversation needs no memory. Other columns are not read.
    """
    kind = turns.schema[conversation].dataType.simpleString()
    narrow = turns.select(
        F.col(conversation).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")
    )
    dealt = narrow.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches):
        formatter, moves = Formatter(template), template.moves
        now, place, state, fine, started = None, 0, "", True, False
        for batch in batches:
            ids, roles, texts = (batch.column(i).to_pylist() for i in (0, 2, 3))
            places, segments, in_order = [], [], []
            for c, r, t in zip(ids, roles, texts, strict=True):
                if not started or c != now:
                    now, place, state, fine, started = c, 0, "", True, True
                fine = fine and r in moves.get(state, ())
                state = r
                places.append(place)
                place += 1
                pieces = formatter.segments(r, t or "")
                segments.append([{"text": x, "learned": y} for x, y in pieces])
                in_order.append(fine)
            piece = pa.struct([("text", pa.string()), ("learned", pa.bool_())])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(places, pa.int64()),
                    pa.array(segments, pa.list_(piece)),
                    pa.array(in_order, pa.bool_()),
                ],
                names=["conv_id", "place", "segments", "in_order"],
            )

    return dealt.mapInArrow(run, f"conv_id {kind}, place long, segments {SEGMENTS}, in_order boolean")


def read_back(formatted: DataFrame, template: Template) -> DataFrame:
    """One row for each conversation, from the formatted turns in the order `format_turns` leaves them in.

    n_turns; turns_sha256 over role, newline, text, newline of each turn (a null role as nothing); loss_chars and
    loss_sha256 of the learned texts, as they were before they were escaped; formatted_chars; valid: whether all turns are in order and
    the last one may end a conversation. Hashes are fed turn by turn, so memory does not grow with a conversation.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def run(batches):
        formatter = Formatter(template)
        now, started, facts = None, False, None

        def result(rows, id_type):
            columns = list(zip(*rows, strict=True)) or [()] * 7
            types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
            )

        def closed():
            turns, loss, n, chars, total, fine, last = facts
            return (now, n, turns.hexdigest(), chars, loss.hexdigest(), total, fine and last in template.last)

        id_type = None
        for batch in batches:
            id_type, rows = batch.column(0).type, []
            columns = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for c, segments, fine in zip(*columns, strict=True):
                if not started or c != now:
                    if started:
                        rows.append(closed())
                    now, started = c, True
                    facts = [hashlib.sha256(), hashlib.sha256(), 0, 0, 0, True, None]
                written = "".join(s["text"] for s in segments)
                role, text, learned = formatter.turn(written)
                facts[0].update(f"{role or ''}\n{text}\n".encode())
                flagged = "".join(formatter.unescape(s["text"]) for s in segments if s["learned"])
                facts[1].update(flagged.encode())
                facts[2] += 1
                facts[3] += len(flagged)
                facts[4] += len(written)
                facts[5] = facts[5] and fine
                facts[6] = role
            yield result(rows, id_type)
        if started:
            yield result([closed()], id_type)

    return formatted.mapInArrow(
        run,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, valid boolean",
    )
