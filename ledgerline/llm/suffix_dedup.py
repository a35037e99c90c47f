"""Removal of repeated passages with a logarithmic family of sparse suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier in the corpus.

Sparse suffixes. Every window of ``LENGTH`` bytes names one of its own positions, the leftmost
one whose ``GRAM`` bytes hash lowest. Equal windows name the same place, so only the named
positions (one in 35) need indexing. The suffix at such a place is ordered by the hash of its
first ``GRAM`` bytes, then by the hash of all bytes that any window around it can reach; equal
prefixes lie together as in a lexicographic suffix array, and comparing two suffixes is comparing
two numbers.

The family. Suffixes are dealt over tasks by their first hash. A task takes its suffixes batch by
batch in document order (``SuffixLevels``): the batch is sorted into a suffix array, merge-scanned
against the existing levels for suffixes met before, and added as a level; levels of similar
size are merged, so that n batches leave about log n levels. A suffix whose whole surroundings
occurred before makes all its windows repeats. If only the first ``GRAM`` bytes occurred with
other surroundings, the stretch of text that its windows cover goes to the prefix's task, where
the windows, suffixes cut off at ``LENGTH`` bytes, pass through a second family of the same kind.

Skew. Within a block of documents a suffix is sent once; its further occurrences are repeats
already. A prefix with many surroundings in one block is known to need the second step, and only
``_WITNESSES`` of them are sent. In the second step the windows of a prefix with more than
``_WIDE`` surroundings are dealt over tasks one by one, again each once for a block. So a passage
or a line that a third of all documents share reaches a task once for each block, not once for
each document.

Rows: a null text is an empty one; texts below ``LENGTH`` bytes keep everything; a null key counts as
earlier than all others; texts with the same key are ordered by their hash; a row repeated whole
(key and text) is one document and gets that document's answer each time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import blocks, keyed_text, text_bytes, written

LENGTH = 100
GRAM = 32
#: Surroundings of one prefix that a block sends to the prefix's task.
_WITNESSES = 8
#: Surroundings beyond which a prefix's windows are dealt one by one.
_WIDE = 1_000
#: Window starts that are handled at a time; positions in a buffer fit 21 binary digits.
_STEP = 1 << 19
_PLACE = (1 << 21) - 1
#: Odd multipliers: the base of the rolling hash, and one that spreads its digits.
_BASE, _SPREAD = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_FIRST = -(1 << 63)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Hashes of any stretch of a buffer, from one pass over its bytes."""

    up = _powers(_BASE, 1)
    down = up

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(Hasher.up) < n:
            Hasher.up = _powers(_BASE, n)
            Hasher.down = _powers(pow(_BASE, -1, 1 << 64), n)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * Hasher.up[: n - 1], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self._spread((self.sums[end] - self.sums[start]) * Hasher.down[start])

    def every(self, length: int) -> np.ndarray:
        """The hash of each stretch of this length."""
        n = len(self.sums) - length
        return self._spread((self.sums[length:] - self.sums[:n]) * Hasher.down[:n])

    @staticmethod
    def _spread(x: np.ndarray) -> np.ndarray:
        x = x ^ (x >> np.uint64(32))
        x *= np.uint64(_SPREAD)
        return x ^ (x >> np.uint64(29))


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    reach = 1
    while 2 * reach <= width:
        keys = np.minimum(keys[:-reach], keys[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys


class Anchors:
    """The named positions of some texts, in their order.

    Per anchor: text (its number), place, begin and end (of the run of windows that name it),
    prefix and around (the two hashes). ``window(at)`` hashes the windows of some anchors.
    """

    def __init__(self, texts: list[bytes]):
        parts = [part for i, raw in enumerate(texts) for part in self._cut(i, raw)]
        self.groups: list[tuple] = []
        group, size = [], 0
        for part in parts:
            group.append(part)
            size += part[2] - part[1]
            if size >= _STEP:
                self._index(texts, group)
                group, size = [], 0
        if group:
            self._index(texts, group)
        empty = np.zeros(0, np.int64)
        columns = list(zip(*self.groups, strict=True)) or [(empty,)] * 6
        self.text, self.place, self.begin, self.end, self.prefix, self.around = map(np.concatenate, columns)

    @staticmethod
    def _cut(i: int, raw: bytes) -> Iterator[tuple[int, int, int, int, int]]:
        """Stretches (text, from, to, first window, window behind the last) with all they reach."""
        last = len(raw) - LENGTH + 1
        for at in range(0, max(last, 0), _STEP):
            end = min(at + _STEP, last)
            yield i, max(0, at - LENGTH + GRAM), min(len(raw), end + 2 * LENGTH - GRAM), at, end

    def _index(self, texts: list[bytes], group: list[tuple[int, int, int, int, int]]) -> None:
        data = np.frombuffer(b"".join(texts[i][a:b] for i, a, b, _, _ in group), np.uint8)
        number, low, high, first, last = np.array(group, np.int64).T
        shift = np.cumsum(high - low) - (high - low)  # where each stretch starts in the buffer
        hashed = Hasher(data)
        grams = hashed.every(GRAM)
        keys = (grams & ~np.uint64(_PLACE)) | np.arange(len(grams), dtype=np.uint64)
        named = (_least(keys, LENGTH - GRAM + 1) & np.uint64(_PLACE)).astype(np.int64)
        count = last - first
        owner = np.repeat(np.arange(len(group)), count)
        window = np.arange(int(count.sum())) + np.repeat(shift + first - low - (np.cumsum(count) - count), count)
        named = named[window]
        start = np.flatnonzero(np.concatenate(([True], (np.diff(named) != 0) | (np.diff(owner) != 0))))
        end = np.concatenate((start[1:], [len(window)]))
        at, owner = named[start], owner[start]
        left = np.minimum(LENGTH - GRAM, at - shift[owner])
        right = np.minimum(LENGTH, shift[owner] + (high - low)[owner] - at)
        around = hashed(at - left, at + right) + (left * 128 + right).astype(np.uint64) * np.uint64(_BASE)
        back = low[owner] - shift[owner]
        self.groups.append(
            (
                number[owner], at + back, window[start] + back, window[end - 1] + back + 1,
                grams[at].view(np.int64), around.view(np.int64),
            )
        )


class SuffixLevels:
    """Sorted arrays of suffixes met so far, about twice the size from one to the next."""

    def __init__(self):
        self.levels: list[dict[str, np.ndarray]] = []

    def add(self, whole: np.ndarray) -> np.ndarray:
        """Take a batch of suffixes in document order; which of them were met before."""
        again = self._met(whole)
        self._push({"whole": np.sort(whole[~again])}, "whole")
        return again

    def add_with_prefix(self, prefix: np.ndarray, whole: np.ndarray, row: np.ndarray, told: np.ndarray):
        """The same for suffixes that share prefixes; ``row`` numbers them, ``told`` marks those
        whose prefix is known to occur with other surroundings.

        Returns the batch's repeats (mask), those whose prefix turns out to occur with other
        surroundings (mask), and row and prefix of earlier suffixes of which this becomes known now.
        """
        again = self._met(whole)
        new = np.flatnonzero(~again)
        new = new[np.argsort(prefix[new], kind="stable")]
        keys = prefix[new]
        same = keys[1:] == keys[:-1]
        shared = np.zeros(len(new), bool)
        shared[1:] |= same
        shared[:-1] |= same
        distinct = keys[np.concatenate(([True], ~same))[: len(keys)]]
        rows, prefixes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for level in self.levels:
            shared |= self._within(level["prefix"], keys)
            now = self._within(distinct, level["prefix"]) & ~level["told"]
            level["told"] |= now
            rows.append(level["row"][now])
            prefixes.append(level["prefix"][now])
        several = np.zeros(len(whole), bool)
        several[new[shared]] = True
        level = {"prefix": keys, "row": row[new], "told": told[new] | shared, "whole": np.sort(whole[new])}
        self._push(level, "prefix")
        return again, several & ~told, np.concatenate(rows), np.concatenate(prefixes)

    def _met(self, whole: np.ndarray) -> np.ndarray:
        order = np.argsort(whole, kind="stable")
        again = np.zeros(len(whole), bool)
        again[order[1:]] = whole[order[1:]] == whole[order[:-1]]
        for level in self.levels:
            again |= self._within(level["whole"], whole)
        return again

    def _push(self, level: dict[str, np.ndarray], sorted_by: str) -> None:
        while self.levels and len(self.levels[-1]["whole"]) < 2 * len(level["whole"]):
            other = self.levels.pop()
            level = {k: np.concatenate((other[k], level[k])) for k in level}
            order = np.argsort(level[sorted_by], kind="stable")
            level = {k: np.sort(v, kind="stable") if k == "whole" else v[order] for k, v in level.items()}
        if len(level["whole"]):
            self.levels.append(level)

    @staticmethod
    def _within(level: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Which of ``wanted`` the sorted array holds."""
        if not len(level):
            return np.zeros(len(wanted), bool)
        place = np.minimum(np.searchsorted(level, wanted), len(level) - 1)
        return level[place] == wanted


_KEYS = ["doc", "sub", "place"]
#: What is known of a suffix: nothing, its windows are repeats, its windows need looking at.
OPEN, REPEAT, LOOK = 0, 1, 2


def _as_before(*columns: np.ndarray) -> np.ndarray:
    """Which rows equal the one before them."""
    same = np.ones(max(len(columns[0]) - 1, 0), bool)
    for x in columns:
        same &= x[1:] == x[:-1]
    return np.concatenate(([False], same))[: len(columns[0])]


def _known(prefix, whole, doc, sub, place) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What a block tells of its own suffixes: the rows to keep, in document order, what is known of
    each, and which of them to ask about elsewhere."""
    order = np.lexsort((place, sub, doc, whole, prefix))
    prefix, whole, doc, sub, place = (x[order] for x in (prefix, whole, doc, sub, place))
    once = ~_as_before(prefix, whole, doc, sub, place)
    order, prefix, whole = order[once], prefix[once], whole[once]
    first = np.flatnonzero(~_as_before(prefix, whole))
    starts = np.flatnonzero(~_as_before(prefix[first]))
    sizes = np.diff(np.concatenate((starts, [len(first)])))
    turn = np.arange(len(first)) - np.repeat(starts, sizes)
    state = np.full(len(order), REPEAT, np.int8)
    state[first] = np.where(np.repeat(sizes > 1, sizes), LOOK, OPEN)
    ask = np.zeros(len(order), bool)
    ask[first] = turn < _WITNESSES
    doc, sub, place = (x[once] for x in (doc, sub, place))
    back = np.lexsort((place, sub, doc))
    return order[back], state[back], ask[back]


def _long(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64)


def _of(names: list[str], batch: pa.RecordBatch) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False) for n in names]


class _Arrivals:
    """Drops rows that repeat the one before them: a document repeated whole brings its rows again."""

    def __init__(self):
        self.last = None

    def fresh(self, keys: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(0, bool)
        before = np.concatenate((keys[:1] - 1 if self.last is None else self.last, keys[:-1]))
        self.last = keys[-1:]
        return (keys != before).any(axis=1)


def suffixes(docs: DataFrame) -> DataFrame:
    """Per indexed position: prefix, whole, doc, sub, place, state, ask."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            found = Anchors(text_bytes(block.column("text")))
            doc, sub = _long(block.column("doc"))[found.text], _long(block.column("sub"))[found.text]
            rows, state, ask = _known(found.prefix, found.around, doc, sub, found.place)
            columns = [x[rows] for x in (found.prefix, found.around, doc, sub, found.place)]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, columns), pa.array(state), pa.array(ask)],
                ["prefix", "whole", *_KEYS, "state", "ask"],
            )

    return docs.select("doc", "sub", "text").mapInArrow(
        task, "prefix long, whole long, doc long, sub long, place long, state byte, ask boolean"
    )


def resolved(rows: DataFrame) -> DataFrame:
    """Per suffix that is a repeat or needs looking at: doc, sub, place, state, prefix."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, arrivals = SuffixLevels(), _Arrivals()
        kept: list[np.ndarray] = []  # keys of the rows that the levels number
        count = 0
        for batch in batches:
            prefix, whole, doc, sub, place, state, ask = _of(["prefix", "whole", *_KEYS, "state", "ask"], batch)
            keys = np.stack((doc, sub, place), axis=1)
            asked = np.flatnonzero(ask)
            asked = asked[arrivals.fresh(keys[asked])]
            again, several, earlier, earlier_prefix = levels.add_with_prefix(
                prefix[asked], whole[asked], count + np.arange(len(asked)), state[asked] == LOOK
            )
            kept.append(keys[asked])
            count += len(asked)
            state = state.copy()
            state[asked[several]] = LOOK
            state[asked[again]] = REPEAT
            told = state != OPEN
            keys, state, prefix = keys[told], state[told], prefix[told]
            if len(earlier):
                kept = [np.concatenate(kept)]
                keys = np.concatenate((keys, kept[0][earlier]))
                state = np.concatenate((state, np.full(len(earlier), LOOK, np.int8)))
                prefix = np.concatenate((prefix, earlier_prefix))
            columns = [*map(pa.array, keys.T.copy()), pa.array(state), pa.array(prefix, mask=state == REPEAT)]
            yield pa.RecordBatch.from_arrays(columns, [*_KEYS, "state", "prefix"])

    by_prefix = F.when(F.col("ask"), F.col("prefix")).otherwise(F.xxhash64(*_KEYS))
    return (
        rows.repartition(by_prefix)
        .sortWithinPartitions(*_KEYS)
        .mapInArrow(task, "doc long, sub long, place long, state byte, prefix long")
    )


def windows(searched: DataFrame) -> DataFrame:
    """Rows (doc, sub, text, look) to runs of windows: key, doc, sub, place (of the first), content.

    ``content`` is the text that a run covers and ``key`` its prefix. Where a prefix is wide, each
    window is a row without content and ``key`` its hash, or null if it is known as a repeat.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            doc, sub = _long(block.column("doc")), _long(block.column("sub"))
            key, owner, place, content = [], [], [], []
            wide_key, wide_owner, wide_place = ([np.zeros(0, np.int64)] for _ in range(3))
            looks = block.column("look").to_pylist()
            for i, (raw, look) in enumerate(zip(text_bytes(block.column("text")), looks, strict=True)):
                found = Anchors([raw])
                is_wide = {x["place"]: x["wide"] for x in look}
                for at in np.flatnonzero(np.isin(found.place, np.array(list(is_wide), np.int64))).tolist():
                    a, b = int(found.begin[at]), int(found.end[at])
                    covered = raw[a : b + LENGTH - 1]
                    if is_wide[int(found.place[at])]:
                        hashed = Hasher(np.frombuffer(covered, np.uint8)).every(LENGTH).view(np.int64)
                        wide_key.append(hashed)
                        wide_owner.append(np.full(b - a, i))
                        wide_place.append(np.arange(a, b))
                    else:
                        key.append(int(found.prefix[at]))
                        owner.append(i)
                        place.append(a)
                        content.append(covered)
            hashed, from_, at = map(np.concatenate, (wide_key, wide_owner, wide_place))
            rows, state, _ = _known(hashed, hashed, doc[from_], sub[from_], at)
            owner = np.concatenate((np.array(owner, np.int64), from_[rows]))
            known = np.concatenate((np.zeros(len(key), bool), state == REPEAT))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((np.array(key, np.int64), hashed[rows])), mask=known),
                    pa.array(doc[owner]),
                    pa.array(sub[owner]),
                    pa.array(np.concatenate((np.array(place, np.int64), at[rows]))),
                    pa.array([*content, *[None] * len(rows)], pa.binary()),
                ],
                ["key", *_KEYS, "content"],
            )

    return searched.mapInArrow(task, "key long, doc long, sub long, place long, content binary")


def repeated_runs(rows: DataFrame) -> DataFrame:
    """Runs of windows that occurred before: doc, sub, begin, end."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, arrivals = SuffixLevels(), _Arrivals()
        for batch in batches:
            doc, sub, place = _of(_KEYS, batch)
            key = batch.column("key")
            known = key.is_null().to_numpy(zero_copy_only=False)
            key = key.fill_null(0).to_numpy()
            content = batch.column("content").to_pylist()
            fresh = arrivals.fresh(np.stack((doc, sub, place), axis=1))
            size = np.fromiter((len(c) - LENGTH + 1 if c else 1 for c in content), np.int64, len(content))
            owner = np.repeat(np.arange(len(size)), size)
            step = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
            hashed = key[owner]
            whole = np.fromiter((c is not None for c in content), bool, len(content))
            data = np.frombuffer(b"".join(c for c in content if c), np.uint8)
            if len(data):
                length = np.where(whole, size + LENGTH - 1, 0)
                start = (np.cumsum(length) - length)[owner] + step
                inside = whole[owner]
                hashed[inside] = Hasher(data)(start[inside], start[inside] + LENGTH).view(np.int64)
            again = known[owner]
            asked = np.flatnonzero(fresh[owner] & ~again)
            again[asked] = levels.add(hashed[asked])
            edge = np.flatnonzero(np.diff(again.astype(np.int8)) | (np.diff(owner) != 0)) + 1
            start = np.concatenate(([0], edge))
            end = np.concatenate((edge, [len(owner)])) - 1
            hit = again[start]
            start, end = start[hit], end[hit]
            row = owner[start]
            columns = [doc[row], sub[row], place[row] + step[start], place[row] + step[end] + 1]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], ["doc", "sub", "begin", "end"])

    dealt = F.coalesce("key", F.xxhash64(*_KEYS))
    return (
        rows.repartition(dealt)
        .sortWithinPartitions(*_KEYS)
        .mapInArrow(task, "doc long, sub long, begin long, end long")
    )


def removals(df: DataFrame, key: str = "doc_id", text: str = "text", keep_bytes: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and on request kept (the bytes left)."""
    docs = keyed_text(df, key, text)
    doc = F.coalesce("doc_id", F.lit(_FIRST))
    several = not docs.groupBy(doc).count().filter("count > 1").isEmpty()
    sub: Column = F.xxhash64("text") if several else F.lit(0).cast("long")
    docs = docs.select(doc.alias("doc"), sub.alias("sub"), "doc_id", "text")

    flags = written(resolved(suffixes(docs)), "repeats")
    look = flags.filter(F.col("state") == LOOK).select("doc", "sub", "place", "prefix")
    wide = look.groupBy("prefix").count().filter(F.col("count") > _WIDE).select("prefix", F.lit(True).alias("wide"))
    look = look.join(wide, "prefix", "left").withColumn("wide", F.coalesce("wide", F.lit(False)))
    # As many entries to a document as it has indexed positions, at most.
    look = look.groupBy("doc", "sub").agg(F.collect_list(F.struct("place", "wide")).alias("look"))
    repeats = flags.filter(F.col("state") == REPEAT).groupBy("doc", "sub").agg(F.collect_list("place").alias("repeats"))
    runs = repeated_runs(windows(docs.join(look, ["doc", "sub"]).select("doc", "sub", "text", "look")))
    runs = runs.groupBy("doc", "sub").agg(F.collect_list(F.struct("begin", "end")).alias("single"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            out = [
                _left(raw, runs or [], single or [])
                for raw, runs, single in zip(
                    text_bytes(block.column("text")),
                    block.column("repeats").to_pylist(),
                    block.column("single").to_pylist(),
                    strict=True,
                )
            ]
            columns = [
                block.column("doc_id"),
                *(pa.array([o[k] for o in out], pa.int64()) for k in range(3)),
                pa.array([hashlib.sha256(o[3]).hexdigest() for o in out], pa.string()),
            ]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep_bytes:
                columns.append(pa.array([o[3] for o in out], pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    marks = repeats.join(runs, ["doc", "sub"], "full")
    return docs.join(marks, ["doc", "sub"], "left").mapInArrow(cut, schema + ", kept binary" * keep_bytes)


def _left(raw: bytes, places: list[int], more: list[dict[str, int]]) -> tuple[int, int, int, bytes]:
    """Bytes in all, bytes removed, runs removed, bytes left."""
    if not places and not more:
        return len(raw), 0, 0, raw
    found = Anchors([raw])
    good = np.isin(found.place, np.array(places, np.int64))
    begins = np.concatenate((found.begin[good], np.array([x["begin"] for x in more], np.int64)))
    ends = np.concatenate((found.end[good], np.array([x["end"] for x in more], np.int64))) + LENGTH - 1
    edge = np.zeros(len(raw) + 1, np.int32)
    np.add.at(edge, begins, 1)
    np.add.at(edge, ends, -1)
    gone = np.cumsum(edge[:-1]) > 0
    spans = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
    left = np.frombuffer(raw, np.uint8)[~gone].tobytes()
    return len(raw), len(raw) - len(left), spans, left
