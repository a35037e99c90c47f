"""Repair of conversations: the cheapest edits that give each a legal order of roles.

A legal conversation is empty, or an optional system row followed by pairs of a user and an
assistant row. Rows are kept (K), given another role (R) or deleted (D), and rows with empty text
are inserted (I). Reading a conversation is a walk through four states (nothing yet, after a
system row, after a user row, after an assistant row), and every row is a table of what it costs to
go from one state to another. Of the cheapest edits, those whose initials come first in ASCII order
are taken.

Hirschberg's divide and conquer finds them without keeping a trace: a cost vector over the four
states goes forward from the front, another backward from the end, both meet in the middle at a
state of least total cost, and each half is solved for itself. Beside its cost, a forward vector
carries the rank of each state's least audit among the four. Audits up to a row end in that row's
own initial, so none is the beginning of another, and the rank alone settles ties.

Tables multiply: a stretch of rows is one table again. A conversation is therefore cut into blocks of at
most ``BLOCK_ROWS`` rows wherever they lie, tasks multiply the tables of their blocks, the meeting states at
the edges are found over one table per block, and every block is rebuilt by itself. One long conversation is
the work of many tasks; only the reading of its texts in order (and a digest over them) is one stream, which
holds a row at a time.

Rows: null roles and texts are one space. Rows go by turn (null first); rows of one turn by role,
then by their text's hash. Equal rows of one turn are counted before they are moved. A text without
anything but white space is blank, an earlier role and text makes a duplicate; both must go. Null
keys are a conversation of their own; an empty table gives no rows; other columns do not come along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import blocks, written

#: Rows of one block; equal rows of a turn count as one.
BLOCK_ROWS = 1 << 16

# The prices of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_STATES = range(4)
#: What may follow each state, and where an inserted row leads.
_FOLLOWS = ({"s": _SYSTEM, "u": _USER}, {"u": _USER}, {"a": _ASSISTANT}, {"u": _USER})
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_ROLE = {_SYSTEM: "system", _USER: "user", _ASSISTANT: "assistant"}
_KINDS = "sua-"
_FINE, _CUT, _MUST_GO = range(3)

#: From one state: (next state, cost, rank of its audit among those from the same state).
Step = tuple[tuple[tuple[int, int, int], ...], ...]


def _steps(kind: str, fault: int) -> tuple[Step, dict[tuple[int, int], str]]:
    """The table of one row, and the initials behind each of its entries."""
    table, audits = [], {}
    for state in _STATES:
        best: dict[int, tuple[int, str]] = {state: (DELETE, "D")}
        at, spent, initials = state, 0, ""
        for _ in range(3):  # rows inserted before this one; a third would lead where the first did
            if fault != _MUST_GO:
                extra = TRUNCATED if fault == _CUT else 0
                kept = (_FOLLOWS[at].get(kind), spent + extra, initials + "K")
                for to, cost, audit in (kept, (_NEXT[at], spent + extra + REROLE, initials + "R")):
                    if to is not None and (to not in best or (cost, audit) < best[to]):
                        best[to] = (cost, audit)
            at, spent, initials = _NEXT[at], spent + INSERT, initials + "I"
        order = sorted(best, key=lambda to: best[to][1])
        table.append(tuple((to, best[to][0], order.index(to)) for to in sorted(best)))
        audits |= {(state, to): audit for to, (_, audit) in best.items()}
    return tuple(table), audits


_ROWS = [_steps(kind, fault) for kind in _KINDS for fault in (_FINE, _CUT, _MUST_GO)]
#: The tables of the rows by code: kind of role times three, plus fault.
STEPS = [table for table, _ in _ROWS]
AUDITS = [audits for _, audits in _ROWS]
#: What remains to be inserted at the end; it leads to the state 0.
_TAIL = ("", "II", "I", "")
_END: Step = tuple(((0, INSERT * len(t), 0),) for t in _TAIL)

#: Cost and rank of every state; None where it cannot be reached.
Vector = list[tuple[int, int] | None]


def _from(state: int) -> Vector:
    return [(0, 0) if s == state else None for s in _STATES]


def _forward(vector: Vector, step: Step, extra: int = 0) -> Vector:
    found: dict[int, tuple[int, int, int]] = {}
    for state, held in enumerate(vector):
        if held is None:
            continue
        cost, rank = held
        for to, more, own in step[state]:
            new = (cost + more + extra, rank, own)
            if to not in found or new < found[to]:
                found[to] = new
    order = sorted(found, key=lambda to: found[to][1:])
    out: Vector = [None] * 4
    for rank, to in enumerate(order):
        out[to] = (found[to][0], rank)
    return out


def _backward(costs: list[float], step: Step) -> list[float]:
    return [min([more + costs[to] for to, more, _ in options], default=float("inf")) for options in step]


def crossings(steps: Sequence[Step], entry: int, leave: int) -> list[int]:
    """The states before, between and after the steps on the audit-least cheapest walk."""
    states = [entry] + [leave] * len(steps)

    def halves(low: int, high: int) -> None:
        if high - low < 2:
            return
        middle = (low + high) // 2
        ahead = _from(states[low])
        for i in range(low, middle):
            ahead = _forward(ahead, steps[i])
        back = [0.0 if s == states[high] else float("inf") for s in _STATES]
        for i in range(high - 1, middle - 1, -1):
            back = _backward(back, steps[i])
        met = [(held[0] + back[s], held[1], s) for s, held in enumerate(ahead) if held is not None]
        states[middle] = min(met)[2]
        halves(low, middle)
        halves(middle, high)

    halves(0, len(steps))
    return states


def product(steps: Sequence[Step], extra: Sequence[int] = ()) -> Step:
    """The table of a stretch of rows."""
    ends = [_from(s) for s in _STATES]
    for i, step in enumerate(steps):
        more = extra[i] if extra else 0
        ends = [_forward(v, step, more) for v in ends]
    return tuple(tuple((to, *held) for to, held in enumerate(v) if held is not None) for v in ends)


def block_audit(codes: bytes, copies: Sequence[int], entry: int, leave: int) -> str:
    """The initials of the edits of one block; copies beyond a row's first are deleted."""
    states = crossings([STEPS[c] for c in codes], entry, leave)
    parts = [AUDITS[c][states[i], states[i + 1]] for i, c in enumerate(codes)]
    if copies:
        parts = [p + "D" * (n - 1) for p, n in zip(parts, copies, strict=True)]
    return "".join(parts)


# Rows to blocks

_KEY = ["conv", "turn", "role", "digest"]
_SPACE = "' \\t\\n\\u000B\\f\\r'"


def _in_order(rows: DataFrame) -> DataFrame:
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


def _groups(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn as one: their number, code, and counts of faults."""
    bare = F.expr(f"trim(TRAILING {_SPACE} FROM text)")
    marked = _in_order(rows).select(
        *_KEY,
        (bare == "").alias("blank"),
        (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    groups = written(
        marked.groupBy(*_KEY).agg(
            F.count("*").alias("copies"), F.max("blank").alias("blank"), F.max("cut").alias("cut")
        ),
        "conversation-groups",
    )
    # The first turn of a role and text; at most one group of those with equal ones has it.
    nulls_first = F.struct(F.col("turn").isNotNull(), "turn")
    first = groups.groupBy("conv", "role", "digest").agg(F.min(nulls_first).alias("first")).select(
        F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), F.col("first.turn").alias("t")
    )
    same = (
        groups["conv"].eqNullSafe(first["c"])
        & (groups["role"] == first["r"])
        & (groups["digest"] == first["d"])
        & groups["turn"].eqNullSafe(first["t"])
    )
    initial = F.left("role", F.lit(1))
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    told = F.col("r").isNotNull() & ~F.col("blank")  # neither blank nor a duplicate
    fault = F.when(~told, _MUST_GO).when(F.col("cut"), _CUT).otherwise(_FINE)
    return groups.join(first, same, "left").select(
        *_KEY, "copies", "blank", (kind * 3 + fault).cast("int").alias("code")
    )


_STATS = ["rows", "blank", "duplicate", "truncated", "illegal", "first_kind", "last_kind", "turns", "first_turn", "last_turn"]


class _Block:
    """Rows of one conversation, in order, as far as one task has them next to each other."""

    def __init__(self, key: tuple):
        self.key = key
        self.codes, self.copies = bytearray(), []
        self.stats = dict.fromkeys(_STATS, 0)
        self.turn = self.stats["first_turn"] = None

    def add(self, turn: int | None, copies: int, blank: bool, code: int) -> None:
        kind, fault = divmod(code, 3)
        s = self.stats
        if self.codes:
            s["illegal"] += not legal(s["last_kind"], kind)
        else:
            s["first_kind"] = kind
        s["last_kind"] = kind
        s["illegal"] += copies - 1  # no role follows itself
        s["rows"] += copies
        s["blank"] += copies if blank else 0
        s["duplicate"] += 0 if blank else copies - (fault != _MUST_GO)
        s["truncated"] += fault == _CUT
        if turn is not None and turn != self.turn:
            s["turns"] += 1
            s["first_turn"] = turn if s["first_turn"] is None else s["first_turn"]
            self.turn = turn
        self.codes.append(code)
        self.copies.append(copies)

    def row(self) -> dict:
        extra = [DELETE * (n - 1) for n in self.copies]
        plain = not any(extra)
        self.stats["last_turn"] = self.turn
        conv, turn, role, digest = self.key
        return {
            "conv": conv, "turn": turn, "role": role, "digest": digest, "codes": bytes(self.codes),
            "copies": [] if plain else self.copies,
            "table": _packed(product([STEPS[c] for c in self.codes], [] if plain else extra)), **self.stats,
        }


def legal(kind: int, following: int) -> bool:
    """Whether the initials of two neighbouring roles are su, ua or au."""
    return (kind, following) in ((0, 1), (1, 2), (2, 1))


def _packed(table: Step) -> list[int]:
    return [n for state, options in enumerate(table) for option in options for n in (state, *option)]


def _unpacked(packed: list[int]) -> Step:
    out: list[list[tuple]] = [[], [], [], []]
    for i in range(0, len(packed), 4):
        out[packed[i]].append(tuple(packed[i + 1 : i + 4]))
    return tuple(tuple(options) for options in out)


_KEY_COLUMNS = "turn bigint, role string, digest binary"


def _schema(like: DataFrame, columns: str) -> T.StructType:
    """The key's column as the table has it, and further ones."""
    conv = T.StructField("conv", like.schema["conv"].dataType)
    return T.StructType([conv, *T.StructType.fromDDL(columns).fields])


def _rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*[column.to_pylist() for column in batch.columns], strict=True)


def _as_batch(rows: list[dict], like: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=like)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


_AT_ONCE = 4096


def _blocks(groups: DataFrame) -> DataFrame:
    stats = ", ".join(f"{name} bigint" for name in _STATS)
    schema = _schema(
        groups, f"{_KEY_COLUMNS}, codes binary, copies array<bigint>, table array<bigint>, {stats}"
    )
    like = _arrow(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, done = None, []
        for batch in batches:
            for conv, turn, role, digest, copies, blank, code in _rows_of(batch):
                if block is None or block.key[0] != conv or len(block.codes) == BLOCK_ROWS:
                    if block is not None:
                        done.append(block.row())
                    block = _Block((conv, turn, role, digest))
                block.add(turn, copies, blank, code)
                if len(done) == _AT_ONCE:
                    yield _as_batch(done, like)
                    done = []
        if block is not None:
            done.append(block.row())
        if done:
            yield _as_batch(done, like)

    ordered = groups.repartitionByRange(*_KEY).sortWithinPartitions(*_KEY)
    return ordered.mapInArrow(work, schema)


# Blocks to audits


def _order(block: dict) -> tuple:
    return block["turn"] is not None, block["turn"] or 0, block["role"].encode(), block["digest"]


def joined(parts: list[dict]) -> list[dict]:
    """Per block of one conversation: its key and its entry and leaving state; the first also has
    the sums over the conversation, the last what is inserted at the end."""
    parts = sorted(parts, key=_order)
    tables = [_unpacked(p["table"]) for p in parts] + [_END]
    states = crossings(tables, _START, 0)
    total = _from(_START)
    for table in tables:
        total = _forward(total, table)
    out = [
        {"turn": p["turn"], "role": p["role"], "digest": p["digest"], "entry": states[i], "leave": states[i + 1],
         "tail": ""}
        for i, p in enumerate(parts)
    ]
    out[-1]["tail"] = _TAIL[states[len(parts)]]
    sums = {name: sum(p[name] for p in parts) for name in ("blank", "duplicate", "truncated", "illegal", "turns")}
    last = None
    for before, part in zip([None, *parts], parts, strict=False):
        if before is not None:
            sums["illegal"] += not legal(before["last_kind"], part["first_kind"])
        if part["first_turn"] is not None:
            sums["turns"] -= part["first_turn"] == last
            last = part["last_turn"]
    firsts = [p["first_turn"] for p in parts if p["first_turn"] is not None]
    gaps = last - firsts[0] + 1 - sums["turns"] if firsts else 0
    out[0]["sums"] = [gaps, *[sums[n] for n in ("blank", "duplicate", "truncated", "illegal")], total[0][0]]
    return out


def _audits(cut: DataFrame) -> DataFrame:
    """Per block: its key, the initials of its edits, and in the first of a conversation the sums."""
    edges_schema = _schema(cut, f"{_KEY_COLUMNS}, entry int, leave int, tail string, sums array<bigint>")
    edges_like = _arrow(edges_schema)
    one = F.struct("turn", "role", "digest", "table", *_STATS)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [{"conv": conv, **row} for conv, parts in _rows_of(batch) for row in joined(parts)]
            yield _as_batch(rows, edges_like)

    # One small table for each BLOCK_ROWS rows of a conversation and for each task it reaches into.
    edges = cut.groupBy("conv").agg(F.collect_list(one).alias("parts")).mapInArrow(meet, edges_schema)
    edges = edges.select(*[F.col(c).alias(f"_{c}") for c in _KEY], "entry", "leave", "tail", "sums")
    same = F.lit(True)
    for c in _KEY:
        same = same & cut[c].eqNullSafe(edges[f"_{c}"])
    both = cut.select(*_KEY, "codes", "copies").join(edges, same).select(
        *_KEY, "codes", "copies", "entry", "leave", "tail", "sums"
    )
    schema = _schema(cut, f"{_KEY_COLUMNS}, audit string, sums array<bigint>")
    like = _arrow(schema)

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                {"conv": conv, "turn": turn, "role": role, "digest": digest, "sums": sums,
                 "audit": block_audit(codes, copies, entry, leave) + tail}
                for conv, turn, role, digest, codes, copies, entry, leave, tail, sums in _rows_of(batch)
            ]
            yield _as_batch(rows, like)

    return both.mapInArrow(rebuild, schema)


# Audits and texts to repaired rows


def _cells(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    cell = lambda name: F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))
    return rows.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
        cell(role).alias("role"), cell(text).alias("text"),
    )


_SUMS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


class _Replay:
    """Edits applied to the rows of one conversation as they pass by."""

    def __init__(self, conv):
        self.conv, self.sums, self.audits = conv, [0] * len(_SUMS), []
        self.pending, self.at, self.state = "", 0, _START
        self.digest, self.position = hashlib.sha256(), -1

    def plan(self, audit: str, sums: list[int] | None) -> None:
        self.pending, self.at = self.pending[self.at :] + audit, 0
        self.audits.append(audit)
        self.sums = sums or self.sums

    def _out(self, role: str, text: str, edit: str) -> dict:
        self.state = _NEXT[self.state] if edit != "K" else _FOLLOWS[self.state][role[0]]
        self.position += 1
        self.digest.update(f"{chr(10) * (self.position > 0)}{role}:{text}".encode())
        return {"conv": self.conv, "position": self.position, "role": role, "text": text, "edit": edit}

    def _inserted(self) -> Iterator[dict]:
        while self.at < len(self.pending) and self.pending[self.at] == "I":
            self.at += 1
            yield self._out(_ROLE[_NEXT[self.state]], "", "I")

    def row(self, role: str, text: str) -> Iterator[dict]:
        yield from self._inserted()
        edit = self.pending[self.at]
        self.at += 1
        if edit == "K":
            yield self._out(role, text, edit)
        elif edit == "R":
            yield self._out(_ROLE[_NEXT[self.state]], text, edit)

    def end(self) -> Iterator[dict]:
        yield from self._inserted()

    def report(self) -> dict:
        sums = dict(zip(_SUMS, self.sums, strict=True))
        return {"conv": self.conv, **sums, "audit": "".join(self.audits), "repaired_sha256": self.digest.hexdigest()}


def _replayed(rows: DataFrame, every: DataFrame, reports: bool) -> DataFrame:
    cells = rows.select("conv", "turn", "role", "text")
    audits = _audits(written(_blocks(_groups(cells)), "conversation-blocks"))
    nothing = {"text": F.lit(None).cast("string"), "audit": F.lit(None).cast("string")}
    none = F.lit(None).cast("array<bigint>")
    texts = _in_order(cells).select(*_KEY, F.lit(2).alias("what"), "text", nothing["audit"].alias("audit"), none.alias("sums"))
    plans = audits.select(*_KEY, F.lit(1).alias("what"), nothing["text"].alias("text"), "audit", "sums")
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in texts.schema.fields[1:4]]
    heads = every.select("conv", *blank, F.lit(0).alias("what"), nothing["text"].alias("text"), nothing["audit"].alias("audit"), none.alias("sums"))
    stream = heads.union(plans).union(texts)
    stream = stream.repartition("conv").sortWithinPartitions("conv", F.col("what") > 0, "turn", "role", "digest", "what")
    sums = ", ".join(f"{name} bigint" for name in _SUMS)
    told = f"{sums}, audit string, repaired_sha256 string"
    schema = _schema(cells, told if reports else "position bigint, role string, text string, edit string")
    like = _arrow(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = None

        def ended() -> list[dict]:
            last = list(one.end())
            return [one.report()] if reports else last

        for block in blocks(batches):
            out = []
            for conv, _, role, _, what, text, audit, sums in _rows_of(block):
                if what == 0:
                    out += ended() if one is not None else []
                    one = _Replay(conv)
                elif what == 1:
                    one.plan(audit, sums)
                elif reports:
                    for _ in one.row(role, text):
                        pass
                else:
                    out += one.row(role, text)
            if out:
                yield _as_batch(out, like)
        if one is not None and (out := ended()):
            yield _as_batch(out, like)

    return stream.mapInArrow(work, schema)


def repaired(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The rows of the repaired conversations: conv, position (from 0), role, text, edit (K, R or I)."""
    rows = _cells(df, conv, turn, role, text)
    return _replayed(rows, rows.select("conv").distinct(), reports=False)


def reports(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    every: DataFrame | None = None,
) -> DataFrame:
    """Per conversation: gaps in its turns, rows that are blank, duplicate or truncated, illegal
    neighbours, and the cost, audit and digest of its repair.

    ``every``: a table of keys to report on, also those without rows (all zeros, empty audit).
    """
    rows = _cells(df, conv, turn, role, text)
    keys = (rows if every is None else every.select(F.col(f"`{conv}`").alias("conv"))).select("conv").distinct()
    return _replayed(rows, keys, reports=True).withColumnRenamed("conv", conv)


def damaged(df: DataFrame) -> DataFrame:
    """``conversations`` rows with faults by the checksum of conversation and turn: dropped, emptied, without
    ends of sentences, repeated, or said by the user. Null roles and texts are one space."""
    told: Column = F.concat_ws(
        ":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    )
    fault = F.crc32(told.cast("binary")) % 20
    text = F.coalesce(F.col("text"), F.lit(" "))
    rows = df.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(fault == 4, "user").otherwise(F.coalesce(F.col("role"), F.lit(" "))).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        fault.alias("fault"),
    )
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.filter("fault <> 0").withColumn("copy", F.explode(copies)).drop("fault", "copy")
