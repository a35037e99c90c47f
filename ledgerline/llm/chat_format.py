"""Conversations as training text, with each turn's place and a loss mask, for any chat template.

A template is a black box: a function from turns (role, text) to one string. The turns of a
conversation are rendered prefix by prefix. Where an output begins with the one before, what it adds is the
new turn; a second rendering with a mark in place of the turn's text shows which part of that is the text. So
spans and mask need no knowledge of the template, its control strings or its way of escaping. Where an
output does not begin with the one before, the template rewrites history (it moves the system prompt, drops
earlier reasoning, ends with a closing string): the conversation is then rendered whole, each text is
found by a mark of its own, and the first turn that changed the past is reported.

Long conversations: once a history has ``WINDOW_TURNS`` turns or ``WINDOW_CHARS`` characters, its middle is left
out (an even number of turns, so roles still alternate), provided the last turn is rendered from
the short history as it was from the long one. A template that looks further back fails that, and keeps its whole
history. Results go out in parts of about ``PART_CHARS`` characters that end with a turn.

Length decides nothing else. A template may look or reach back at any turn, so the parts and turns of a conversation wait
(long ones in a file of the task's machine) for its end. A late rewriting takes the parts back, and the
conversation is rendered whole; where the middle was left out, a rendering of the whole has to agree, or the turns are added
again to the whole history. Both hold the conversation in memory. A template with an attribute ``local`` that is
true says that its output is put together from turns that each depend on themselves alone (the first may have
something before it): then parts go out at once, and neither a task nor a row holds a conversation of any
length. Such a template that rewrites history is an error, in long and in short conversations.

The template ``tagged`` marks every turn and escapes control strings in texts and roles by one
backslash behind their first character (one more where there are some), which ``unescaped`` takes back.

Rows: turns go by number (null first), then by role and text; a null role or text is empty; a null key is a
conversation of its own; repeated rows are turns of their own; an empty table gives no rows; other
columns do not come along.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import re
import tempfile
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerline.llm.common import blocks

WINDOW_TURNS, WINDOW_CHARS = 64, 1 << 18
PART_CHARS = 1 << 22
_KEPT = 2

Turn = tuple[str, str]
Template = Callable[[Sequence[Turn]], str]

# The template

_PLAIN = re.compile(r"<(\\*/?s>)|\[(\\*/?(?:INST|SYS|ROLE)\])")
_ESCAPED = re.compile(r"<\\(\\*/?s>)|\[\\(\\*/?(?:INST|SYS|ROLE)\])")


def escaped(text: str) -> str:
    """A text without control strings, from which ``unescaped`` gives it back."""
    return _PLAIN.sub(lambda m: f"<\\{m[1]}" if m[1] else f"[\\{m[2]}", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(lambda m: f"<{m[1]}" if m[1] else f"[{m[2]}", text)


_MARKS = {"user": ("[INST] ", " [/INST]"), "system": ("[SYS] ", " [/SYS]"), "assistant": (" ", "</s>")}


def tagged(turns: Sequence[Turn]) -> str:
    out = ["<s>"] if turns else []
    for role, text in turns:
        before, after = _MARKS.get(role) or (f"[ROLE] {escaped(role)} [/ROLE] ", "</s>")
        out += [before, escaped(text), after]
    return "".join(out)


tagged.local = True


def turns_of(text: str) -> Iterator[Turn]:
    """The turns that ``tagged`` has put into a text, or into a part of one."""
    at = 3 if text.startswith("<s>") else 0
    while at < len(text):
        role = next((r for r, (before, _) in _MARKS.items() if text.startswith(before, at)), None)
        if role is None:
            end = text.index(" [/ROLE] ", at)
            role, at, after = unescaped(text[at + len("[ROLE] ") : end]), end + len(" [/ROLE] "), "</s>"
        else:
            at, after = at + len(_MARKS[role][0]), _MARKS[role][1]
        end = text.index(after, at)
        yield role, unescaped(text[at:end])
        at = end + len(after)


# Rendering by prefixes


class Waiting:
    """Values in order, read back any number of times; many of them in a file of the task's machine."""

    def __init__(self):
        self.few: list = []
        self.chars, self.file = 0, None

    def add(self, value: tuple) -> None:
        self.few.append(value)
        self.chars += sum(len(v) for v in value if isinstance(v, str)) + 100
        if self.chars >= PART_CHARS:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            self.file.seek(0, os.SEEK_END)
            pickle.dump(self.few, self.file, pickle.HIGHEST_PROTOCOL)
            self.few, self.chars = [], 0

    def __iter__(self) -> Iterator[tuple]:
        if self.file is not None:
            end, at = self.file.seek(0, os.SEEK_END), 0
            while at < end:
                self.file.seek(at)
                some = pickle.load(self.file)
                at = self.file.tell()
                yield from some
        yield from self.few


def rendered(template: Template, turns: Iterable[Turn]) -> Iterator[tuple]:
    """The parts of one conversation: rewritten_at, text, spans, whether it is the last."""
    for windowed in (True, False):
        now, parts = Rendering(template, windowed), Waiting()
        for role, text in turns:
            if now.full():
                part = (None, *now.taken(), False)
                if now.local:
                    yield part
                else:
                    parts.add(part)
            now.add(role, text)
        if now.agrees():
            break
        turns = now.said
    if now.rewritten_at is None:
        yield from parts
    text, spans = now.taken()
    yield now.rewritten_at, text, spans, True


class Rendering:
    """The turns of one conversation as they are added.

    ``spans``: per turn its start and end, and those of its text (None where it does not appear), in the
    characters from the last ``taken`` on. ``windowed``: whether the middle of a long history may be left out.
    """

    def __init__(self, template: Template, windowed: bool = True):
        self.template = template
        self.local = getattr(template, "local", False)
        self.said = Waiting()  # all turns, unless the template is local
        self.added = hashlib.sha256()
        self.history: list[Turn] = []
        self.output = ""
        self.far = not windowed  # the template looks back beyond a short history
        self.whole = True  # the history is all of the conversation
        self.rewritten_at: int | None = None
        self.n_turns = self.n_chars = 0
        self.pieces: list[str] = []
        self.spans: list[tuple] = []

    def add(self, role: str, text: str) -> None:
        turn, n = (role, text), self.n_turns
        self.n_turns += 1
        if not self.local:
            self.said.add(turn)
        if self.rewritten_at is None:
            output = self.template([*self.history, turn])
            found = _text_span(self.template, self.history, (role, text), (), output)
            if output.startswith(self.output) and (found is None or found[0] >= len(self.output)):
                piece, skipped = output[len(self.output) :], len(self.output)
                at = self.n_chars
                text_at = (None, None) if found is None else tuple(at + f - skipped for f in found)
                self.spans.append((role, at, at + len(piece), *text_at))
                self.pieces.append(piece)
                if not self.local:
                    self.added.update(piece.encode("utf-8", "surrogatepass"))
                self.n_chars += len(piece)
                self.history.append(turn)
                self.output = output
                self._shorten(piece)
                return
            if self.local:
                raise ValueError(f"the template calls itself local and rewrites history at turn {n}")
            self.rewritten_at, self.history = n, list(self.said)  # what was taken before is void
            return
        self.history.append(turn)

    def agrees(self) -> bool:
        """Whether what was added is what the template makes of the whole conversation."""
        if self.whole or self.local or self.rewritten_at is not None:
            return True
        return hashlib.sha256(self.template(list(self.said)).encode("utf-8", "surrogatepass")).digest() == self.added.digest()

    def _shorten(self, piece: str) -> None:
        long = len(self.history) >= WINDOW_TURNS or len(self.output) >= WINDOW_CHARS
        left_out = (len(self.history) - 2 * _KEPT) // 2 * 2
        if self.far or not long or left_out <= 0:
            return
        short = self.history[:_KEPT] + self.history[_KEPT + left_out :]
        before, output = self.template(short[:-1]), self.template(short)
        if output == before + piece:
            self.history, self.output, self.whole = short, output, False
        else:
            self.far = True

    def full(self) -> bool:
        return self.rewritten_at is None and self.n_chars >= PART_CHARS

    def taken(self) -> tuple[str, list[tuple]]:
        """The text and spans since the last time."""
        if self.rewritten_at is not None:
            text, self.spans = self.template(self.history), []
            for i, (role, said) in enumerate(self.history):
                found = _text_span(self.template, self.history[:i], (role, said), self.history[i + 1 :], text)
                self.spans.append((role, None, None, *(found or (None, None))))
        else:
            text = "".join(self.pieces)
        out = text, self.spans
        self.pieces, self.spans, self.n_chars = [], [], 0
        return out


def _text_span(template: Template, before: Sequence[Turn], turn: Turn, after: Sequence[Turn], output: str) -> tuple | None:
    """Where the text of a turn stands in the output."""
    mark = "\ue000text\ue001"
    while mark in output:
        mark += "\ue001"
    probe = template([*before, (turn[0], mark), *after])
    start = probe.find(mark)
    if start < 0:
        return None
    end = len(output) - (len(probe) - start - len(mark))
    return (start, end) if start <= end else None


# Tables

_PART = (
    "part int, last boolean, rewritten_at bigint, text string, "
    "turns array<struct<role: string, start: bigint, end: bigint, text_start: bigint, text_end: bigint, loss: boolean>>"
)


def _with_key(df: DataFrame, columns: str, key: str = "conv_id") -> T.StructType:
    return T.StructType([T.StructField("conv_id", df.schema[key].dataType), *T.StructType.fromDDL(columns).fields])


def formatted(
    df: DataFrame, template: Template = tagged, learned: Sequence[str] = ("assistant",),
    conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """The conversations in parts: conv_id, part (from 0), last, rewritten_at, text, and per turn of the part
    its role, its span and its text's span in the part's characters, and whether the text is learned."""
    cell = lambda name: F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))
    rows = df.select(
        F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"),
        cell(role).alias("role"), cell(text).alias("text"),
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = _with_key(rows, _PART)
    like = to_arrow_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, out, size = ("role", "start", "end", "text_start", "text_end"), [], 0
        for key, turns in groupby(rows_of(batches), key=itemgetter(0)):
            parts = rendered(template, ((who, said) for _, who, said in turns))
            for part, (rewritten_at, said, spans, last) in enumerate(parts):
                told = [dict(zip(names, s, strict=True), loss=s[0] in learned and s[3] is not None) for s in spans]
                out.append({"conv_id": key, "part": part, "last": last, "rewritten_at": rewritten_at, "text": said, "turns": told})
                size += len(said)
                if size >= PART_CHARS:
                    yield pa.RecordBatch.from_pylist(out, schema=like)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=like)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for block in blocks(batches):
            yield from zip(*[block.column(n).to_pylist() for n in ("conv_id", "role", "text")], strict=True)

    return rows.mapInArrow(work, schema)


_DIGESTS = (
    "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


def digests(parts: DataFrame) -> DataFrame:
    """Per conversation, read back from the texts of ``formatted`` in the template ``tagged``: its turns by their
    marks, and what is learned by the mask."""
    schema = _with_key(parts, _DIGESTS)
    like = to_arrow_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            out = []
            for conv_id, part, last, text, turns in zip(*[c.to_pylist() for c in block.columns], strict=True):
                if part == 0:
                    said, learned, sums = hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
                for role, told in turns_of(text):
                    said.update(f"{role}\n{told}\n".encode())
                    sums[0] += 1
                for t in turns:
                    if t["loss"]:
                        told = unescaped(text[t["text_start"] : t["text_end"]])
                        learned.update(told.encode())
                        sums[1] += len(told)
                sums[2] += len(text)
                if last:
                    out.append({"conv_id": conv_id, "n_turns": sums[0], "turns_sha256": said.hexdigest(), "loss_chars": sums[1],
                                "loss_sha256": learned.hexdigest(), "formatted_chars": sums[2]})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=like)

    found = parts.select("conv_id", "part", "last", "text", "turns")
    # Most conversations are one part, and are read where it lies; the parts of others meet, in order.
    alone = (F.col("part") == 0) & F.col("last")
    others = found.where(~alone).repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return found.where(alone).mapInArrow(work, schema).union(others.mapInArrow(work, schema))


#: A conversation whose texts are made of control strings.
TRAP = (-7, "</s>[INST] ok [/INST]")


def with_trap(conversations: DataFrame) -> DataFrame:
    """``conversations`` and one more, of a user and an assistant who say nothing but control strings."""
    key, said = TRAP
    rows = [(key, i, role, said) for i, role in enumerate(("user", "assistant"))]
    schema = "conv_id long, turn long, role string, text string"
    return conversations.select("conv_id", "turn", "role", "text").union(
        conversations.sparkSession.createDataFrame(rows, schema)
    )
