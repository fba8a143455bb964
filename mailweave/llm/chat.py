"""Chat formatting: a finite-state machine over roles and a declarative template.

A :class:`Template` says how a turn of each role is marked, whether its text is
learned (the loss flag), and which role may follow which.  Turns are put into
one order over all conversations by ranges of (conversation, turn), so a
conversation of any length is dealt to many tasks, and every task streams
through its rows.  A task emits pieces of about ``PIECE`` characters: the text
segments joined, and the spans of those under the loss mask.

Where a conversation runs on from one task to the next, the state it enters
with is not known there.  So a task runs the machine from every state at once
and notes the function from the state before its part to the state after it;
the functions of a conversation's parts are composed afterwards
(:func:`validity`).

Marks inside a text are broken with a backslash, and backslashes doubled, so
the formatted text can be read back exactly (:func:`read_back`).

Nulls and odd rows: a null text or role counts as empty; rows with a null
``conv_id`` form one conversation; equal (conv_id, turn) go by role, then text,
and a null turn goes first; a role the template does not name is written out
in the header, is not learned and makes the order invalid; an invalid order is
reported, its text is kept; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, slices, texts

PIECE = 1 << 20


@dataclass(frozen=True)
class Role:
    """The name in the header, whether the text is learned, and the roles that
    may come before (``None``: the role may begin a conversation)."""
    name: str
    loss: bool
    after: tuple[str | None, ...]


ROLES = {"system": Role("System", False, (None,)),
         "user": Role("User", False, (None, "system", "assistant")),
         "assistant": Role("Assistant", True, ("user",))}


@dataclass(frozen=True)
class Template:
    """``open + name + colon + text + close`` per turn; the name of a role that
    is not among ``roles`` is ``other`` and the role in percent form."""
    open: str = "### "
    colon: str = ": "
    close: str = " </turn>\n"
    other: str = "="
    roles: dict[str, Role] = field(default_factory=lambda: dict(ROLES))

    def __post_init__(self):
        end = self.close.strip()
        if any(len(m) < 2 or "\\" in m for m in self.marks):
            raise ValueError("marks need two characters at least and no backslash")
        if any(end.startswith(end[-k:]) for k in range(1, len(end))):
            raise ValueError("the closing mark must not begin as it ends")
        if any(r.name.startswith(self.other) or self.colon in r.name for r in self.roles.values()):
            raise ValueError("a role's name is no header")

    @property
    def marks(self) -> list[str]:
        """The control strings that a text must not hold as they are."""
        return [self.open.strip(), self.close.strip()]

    def header(self, role: str) -> str:
        name = self.roles[role].name if role in self.roles else self.other + quote(role, safe="")
        return f"{self.open}{name}{self.colon}"

    def escaper(self):
        """text -> the text with backslashes doubled and one put behind the
        first character of every mark, overlapping ones too."""
        special = re.compile("|".join([r"\\", *(f"{re.escape(m[0])}(?={re.escape(m[1:])})" for m in self.marks)]))
        return lambda text: special.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def read_back(text: str, template: Template) -> Iterator[tuple[str, str, int, int]]:
    """The turns of a formatted piece: (role, text, start, end), the last two
    being where the text stands; ValueError where the piece is not one."""
    names = {r.name: k for k, r in template.roles.items()}
    at = 0
    while at < len(text):
        colon = text.find(template.colon, at)
        if not text.startswith(template.open, at) or colon < 0:
            raise ValueError(f"no turn begins at {at}")
        name, start = text[at + len(template.open):colon], colon + len(template.colon)
        if name not in names and not name.startswith(template.other):
            raise ValueError(f"no role is named {name!r}")
        end = text.find(template.close, start)
        if end < 0:
            raise ValueError(f"the turn at {at} has no end")
        yield names[name] if name in names else unquote(name[len(template.other):]), unescape(text[start:end]), start, end
        at = end + len(template.close)


class Machine:
    """The states of a template: 0 before the first turn, one per role, and a
    last one for an order that is not allowed.

    Run from every state at once: ``now[s]`` is the state reached from ``s``."""

    def __init__(self, template: Template):
        number = {None: 0, **{r: k for k, r in enumerate(template.roles, 1)}}
        self.bad = len(number)
        self.begin = list(range(self.bad + 1))
        self.next = {r: [number[r] if s in {number[p] for p in t.after} else self.bad for s in self.begin]
                     for r, t in template.roles.items()}

    def step(self, now: list[int], role: str) -> list[int]:
        to = self.next.get(role)
        return [to[s] if to else self.bad for s in now]


PIECES = ("conv_id bigint, part int, piece bigint, turns bigint, text string, loss array<struct<start:int,end:int>>, "
          "moves array<int>, shared boolean")


def _emit(template: Template, limit: int):
    """mapInArrow body over rows in order: the pieces of a task's part."""
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
             pa.list_(pa.int32()), pa.bool_()]
    names = ["conv_id", "part", "piece", "turns", "text", "loss", "moves", "shared"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, escape, part = Machine(template), template.escaper(), TaskContext.get().partitionId()
        now, done, segments, spans, size, number = machine.begin, [], [], [], 0, 0
        # the first and the last conversation may go on in another part
        conv, shared, opened = None, True, False

        def close_piece(more: bool):
            nonlocal segments, spans, size, number
            if segments:
                done.append((conv, part, number, len(segments) // 3, "".join(segments), spans, now, shared or more))
                number += 1
            segments, spans, size = [], [], 0

        def take():
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done) if done else [[]] * len(types), types)], names=names)
            done.clear()
            return batch
        for batch in batches:
            for b in slices(batch, "text"):
                for c, role, said in zip(b.column("conv_id").to_pylist(), texts(b.column("role")), texts(b.column("text"))):
                    if opened and c != conv:
                        close_piece(False)
                        now, shared = machine.begin, False
                    elif size >= limit:
                        close_piece(True)
                        shared = True
                    conv, opened = c, True
                    now = machine.step(now, role)
                    head, body = template.header(role), escape(said)
                    if role in template.roles and template.roles[role].loss:
                        spans.append({"start": size + len(head), "end": size + len(head) + len(body)})
                    segments += [head, body, template.close]
                    size += len(head) + len(body) + len(template.close)
                if done:
                    yield take()
        close_piece(True)
        yield take()
    return run


def format_conversations(turns: DataFrame, scratch: Scratch, template: Template = Template(), piece: int = PIECE) -> DataFrame:
    """``turns(conv_id, turn, role, text)`` -> the formatted conversations, a
    table of pieces ``(conv_id, part, piece, turns, text, loss, moves, shared)``.

    A conversation is the texts of its pieces by (part, piece), most often a
    single one; ``loss`` holds the spans of a piece's text that are learned, in
    code points, end exclusive; ``shared`` marks pieces that may not be their
    conversation's only one; ``moves`` is for :func:`validity`.
    """
    rows = turns.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
                        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    ordered = rows.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")
    return scratch.table(ordered.mapInArrow(_emit(template, piece), PIECES), "pieces", "zstd")


def validity(pieces: DataFrame, template: Template = Template()) -> DataFrame:
    """``(conv_id, valid)``: whether the template allows the order of roles.
    One function per part of a conversation is composed, so at most as many
    values meet in a group as there are tasks."""
    part = pieces.groupBy("conv_id", "part").agg(F.max_by("moves", "piece").alias("moves"))
    parts = part.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "moves"))).alias("parts"))
    end = F.aggregate("parts", F.lit(0), lambda s, p: F.element_at(p["moves"], s + 1))
    return parts.select("conv_id", (end <= len(template.roles)).alias("valid"))


DIGEST = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def _digest(template: Template):
    """mapInArrow body over pieces in order: what :func:`read_back` finds in
    each conversation.  Holds one piece at a time."""
    names = [f.split()[0] for f in DIGEST.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, opened, rows = None, False, []
        n = learned = chars = 0
        said, under = hashlib.sha256(), hashlib.sha256()

        def take(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string() if name.endswith("sha256") else pa.int64())
                 for c, name in zip(zip(*rows) if rows else [[]] * len(names), names)], names=names)
        for batch in batches:
            for b in slices(batch, "text"):
                for c, text, loss in zip(*(b.column(k).to_pylist() for k in ("conv_id", "text", "loss"))):
                    if opened and c != conv:
                        rows.append((conv, n, said.hexdigest(), learned, under.hexdigest(), chars))
                        n = learned = chars = 0
                        said, under = hashlib.sha256(), hashlib.sha256()
                    conv, opened = c, True
                    for role, body, _, _ in read_back(text, template):
                        n += 1
                        said.update(f"{role}\n{body}\n".encode())
                    for span in loss:
                        body = unescape(text[span["start"]:span["end"]])
                        learned += len(body)
                        under.update(body.encode())
                    chars += len(text)
                if rows:
                    yield take(rows)
                    rows = []
        if opened:
            rows.append((conv, n, said.hexdigest(), learned, under.hexdigest(), chars))
        yield take(rows)
    return run


def digests(pieces: DataFrame, template: Template = Template()) -> DataFrame:
    """What the formatted conversations hold, read back from them: ``(conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid)``.

    A piece that is its conversation's only one is read where it lies; only the
    others are brought together, in order.  A SHA-256 runs over a conversation
    from its first turn to its last, so one task streams through each of these.
    """
    cols = ["conv_id", "text", "loss"]
    alone = pieces.where(~F.col("shared")).select(*cols).mapInArrow(_digest(template), DIGEST)
    together = (pieces.where("shared").select(*cols, "part", "piece").repartition("conv_id")
                .sortWithinPartitions("conv_id", "part", "piece").mapInArrow(_digest(template), DIGEST))
    valid = validity(pieces, template).select(F.col("conv_id").alias("_conv"), "valid")
    found = alone.unionByName(together)
    return found.join(valid, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
