r"""Chat formatting with a grammar round trip.

A conversation is rendered turn by turn:

    turn  = "### " role "|" level ": " body "</turn>\n"
    role  = letters, digits, "_" and "-"; other bytes as %XX
    level = "0" (body stands as it is) or "1" (body is escaped)
    body  = text without "###" and "</turn>"; at level 1 a backslash makes the
            next "\", "###" or "</turn>" ordinary text

Every rendered turn is reparsed by the deterministic parser below and compared
with its source. A turn that comes back different is rendered at the next level
until it is identical, so only texts that hold control strings are changed.

Scale: rendering and checking are done row by row, with no shuffle. Reading
back deals turns by conversation and sorts them there; a task then streams:
hashes and lengths are updated turn by turn, so a conversation of any length
needs the memory of one turn.

Defined cases: null texts and roles are empty; turns sort by turn (null first),
role, text, so repeated rows stay, each a turn of its own; a null conv_id is a
conversation of its own; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bound_batches, by_batch

OPEN, CLOSE = "### ", "</turn>"
HEAD = re.compile(r"### ([A-Za-z0-9_%-]*)\|([01]): ")
CONTROL = re.compile(r"\\|###|</turn>")
ESCAPED = re.compile(r"\\(\\|###|</turn>)|(###|</turn>)")
PLAIN = re.compile(r"()(###|</turn>)")
#: The role whose text is under the loss mask.
LEARNED = "assistant"


class Malformed(ValueError):
    """A text that the grammar does not derive."""


def _role_out(role: str) -> str:
    return re.sub(rb"[^A-Za-z0-9_-]", lambda m: b"%%%02X" % m[0][0], role.encode("utf-8", "surrogatepass")).decode("ascii")


def _role_in(role: str) -> str:
    if re.search("%(?![0-9A-F]{2})", role):
        raise Malformed(f"role {role!r}")
    return re.sub(rb"%([0-9A-F]{2})", lambda m: bytes([int(m[1], 16)]), role.encode()).decode("utf-8", "surrogatepass")


def render_turn(role: str, text: str, level: int) -> str:
    body = CONTROL.sub(lambda m: "\\" + m[0], text) if level else text
    return f"{OPEN}{_role_out(role)}|{level}: {body}{CLOSE}\n"


def parse(rendered: str) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn; Malformed where the grammar ends."""
    at = 0
    while at < len(rendered):
        head = HEAD.match(rendered, at)
        if not head:
            raise Malformed(f"no turn at {at}")
        at, parts = head.end(), []
        for m in (ESCAPED if head[2] == "1" else PLAIN).finditer(rendered, at):
            if m[1]:
                parts += [rendered[at : m.start()], m[1]]
                at = m.end()
            elif m[2] == CLOSE:
                parts.append(rendered[at : m.start()])
                at = m.end()
                break
            else:
                raise Malformed(f"a turn opens inside a turn at {m.start()}")
        else:
            raise Malformed("a turn has no end")
        if rendered[at : at + 1] != "\n":
            raise Malformed(f"no line end at {at}")
        at += 1
        yield _role_in(head[1]), "".join(parts)


def format_turn(role: str | None, text: str | None) -> str:
    """The first rendering that parses back to the very turn."""
    role, text = role or "", text or ""
    for level in (0, 1):
        rendered = render_turn(role, text, level)
        try:
            if list(parse(rendered)) == [(role, text)]:
                return rendered
        except Malformed:
            pass
    raise Malformed(f"turn of {role!r} does not survive")  # not reached: level 1 escapes all that is control


def format_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, formatted: a row of input each. The formatted
    conversation is the concatenation of its turns in order."""

    def make():
        def step(batch):
            turns = zip(batch["role"].to_pylist(), batch["text"].to_pylist(), strict=True)
            return {k: batch[k] for k in ("conv_id", "turn", "role", "text")} | {"formatted": [format_turn(r, t) for r, t in turns]}

        return step

    return by_batch(
        conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")),
        make,
        "conv_id long, turn long, role string, text string, formatted string",
    )


class Reader:
    """Reads one conversation, piece by piece."""

    def __init__(self) -> None:
        self.turns, self.loss, self.chars = 0, 0, 0
        self.all, self.learned = hashlib.sha256(), hashlib.sha256()

    def read(self, piece: str) -> None:
        self.chars += len(piece)
        for role, text in parse(piece):
            self.turns += 1
            raw = text.encode("utf-8", "surrogatepass")
            self.all.update(role.encode("utf-8", "surrogatepass") + b"\n" + raw + b"\n")
            if role == LEARNED:
                self.loss += len(text)
                self.learned.update(raw)

    def row(self, conv_id: int | None) -> tuple:
        return conv_id, self.turns, self.all.hexdigest(), self.loss, self.learned.hexdigest(), self.chars


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(turns: DataFrame) -> DataFrame:
    """READ, from the formatted column of format_turns alone."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in READ.split(", ")]
        reader, current, done = None, None, []
        for batch in batches:
            for conv, piece in zip(batch["conv_id"].to_pylist(), batch["formatted"].to_pylist(), strict=True):
                if reader is None or conv != current:
                    if reader:
                        done.append(reader.row(current))
                    reader, current = Reader(), conv
                reader.read(piece)
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in done], schema=_SCHEMA)
                done = []
        if reader:
            yield pa.RecordBatch.from_pylist([dict(zip(names, reader.row(current), strict=True))], schema=_SCHEMA)

    bound_batches(turns.sparkSession)
    ordered = (
        turns.select("conv_id", "turn", "role", "formatted")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), "formatted")
    )
    return ordered.select("conv_id", "formatted").mapInArrow(run, READ)


_SCHEMA = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in READ.split(", ")])
