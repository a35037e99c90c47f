"""Benchmark decontamination with FM-indexes over the words of each training shard.

A test item gives windows: ten consecutive words, or the whole item when it is shorter. A task
takes its shard of documents block by block and indexes each block: the word sequence (documents
divided by separators) gets a suffix array, its Burrows-Wheeler transform goes into a wavelet
tree, and every eighth suffix position is kept. The windows of all items are searched backward
through the tree's ranks, side by side in arrays; each hit range is located by walking to the
next kept position, and the hits of a document are merged into spans of words.

Only words that occur in some window can take part in a match. Every other word is written as
one separator before indexing, and runs too short to hold the shortest window are left out. This
changes no answer and keeps the alphabet to the benchmark's own words.

Test phrases reach the tasks in groups of at most ``GROUP_WORDS`` words; a larger benchmark takes
several passes over the documents, whose hits are united afterwards.

Words: runs of digits, letters A-Z lower-cased, and all bytes beyond ASCII. Rows: null texts and
texts without words have no hits; items without words are passed over; an item without an id is searched
like any other, but has no id to be listed by and is not counted among ``items``; equal items are reported
under each of their ids; repeated documents are answered row by row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import by_block, text_bytes

WINDOW_WORDS = 10
#: Words of test items that one pass searches for; about 20 MB in a task.
GROUP_WORDS = 500_000
_SAMPLE = 8
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


class Windows:
    """The windows of a group of test items, as numbers of the group's own words."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window_words: int):
        self.items = [name for name, _ in items]
        self.number: dict[bytes, int] = {}
        seen: dict[tuple[int, ...], int] = {}
        pairs = set()
        for i, (_, words) in enumerate(items):
            ids = [self.number.setdefault(w, len(self.number) + 2) for w in words]
            n = min(window_words, len(ids))
            for at in range(len(ids) - n + 1 if n else 0):
                pairs.add((seen.setdefault(tuple(ids[at : at + n]), len(seen)), i))
        self.lengths = np.array([len(w) for w in seen], np.int64)
        self.padded = np.zeros((len(seen), window_words), np.int64)
        for k, w in enumerate(seen):
            self.padded[k, : len(w)] = w
        order = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.item_of = order[:, 1]
        self.first_item = np.searchsorted(order[:, 0], np.arange(len(seen) + 1))
        self.shortest = int(self.lengths.min()) if len(seen) else 0


class WaveletTree:
    """Ranks of symbols in a sequence, one bit of the symbol a level (a wavelet matrix)."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels = []
        for bit in range(max(int(top).bit_length(), 1) - 1, -1, -1):
            ones = (symbols >> bit) & 1
            before = np.concatenate(([0], np.cumsum(ones)))
            zeros = len(symbols) - int(before[-1])
            self.levels.append((bit, before, zeros))
            symbols = np.concatenate((symbols[ones == 0], symbols[ones == 1]))

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place, all at once."""
        start, place = np.zeros_like(places), places.copy()
        for bit, before, zeros in self.levels:
            one = ((symbols >> bit) & 1).astype(bool)
            start = np.where(one, zeros + before[start], start - before[start])
            place = np.where(one, zeros + before[place], place - before[place])
        return place - start

    def access(self, places: np.ndarray) -> np.ndarray:
        """The symbols at the places."""
        found, place = np.zeros_like(places), places.copy()
        for bit, before, zeros in self.levels:
            one = (before[place + 1] - before[place]).astype(bool)
            found |= one.astype(np.int64) << bit
            place = np.where(one, zeros + before[place], place - before[place])
        return found


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffix positions in order, by prefix doubling; a shorter suffix comes before its extensions."""
    rank, reach = symbols.astype(np.int64), 1
    while True:
        after = np.zeros_like(rank)
        if reach < len(rank):
            after[:-reach] = rank[reach:] + 1
        order = np.lexsort((after, rank))
        changed = (np.diff(rank[order]) != 0) | (np.diff(after[order]) != 0)
        rank[order] = np.concatenate(([0], np.cumsum(changed)))
        reach *= 2
        if rank[order[-1]] == len(rank) - 1:
            return order


class FmIndex:
    """Backward search and location over one block's words."""

    def __init__(self, symbols: np.ndarray):
        # The end sign, smaller than all, makes every suffix differ from the others.
        text = np.concatenate((symbols, [0]))
        order = suffix_array(text)
        top = int(text.max())
        self.size = len(text)
        self.tree = WaveletTree(text[order - 1], top)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=top + 1))))
        kept = order % _SAMPLE == 0
        self.kept_before = np.concatenate(([0], np.cumsum(kept)))
        self.kept = order[kept]

    def search(self, windows: Windows, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix range of each chosen window, all searched in step from their last words."""
        low = np.zeros(len(chosen), np.int64)
        high = np.full(len(chosen), self.size, np.int64)
        for step in range(int(windows.lengths[chosen].max())):
            left = windows.lengths[chosen] - 1 - step
            live = np.flatnonzero((left >= 0) & (low < high))
            symbol = windows.padded[chosen[live], left[live]]
            low[live] = self.before[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.tree.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The positions of suffixes, by steps back to the next kept one."""
        rows = rows.copy()
        steps = np.zeros(len(rows), np.int64)
        live = np.arange(len(rows))
        while len(live):
            at = rows[live]
            live = live[self.kept_before[at + 1] == self.kept_before[at]]
            if not len(live):
                break
            at = rows[live]
            symbol = self.tree.access(at)
            rows[live] = self.before[symbol] + self.tree.rank(symbol, at)
            steps[live] += 1
        return self.kept[self.kept_before[rows]] + steps


def _runs(ids: np.ndarray, owner: np.ndarray, shortest: int) -> np.ndarray:
    """Places of words that lie in a run of known words of one document long enough to match."""
    known = ids > 0
    edge = np.flatnonzero((known[1:] != known[:-1]) | (owner[1:] != owner[:-1])) + 1
    starts = np.concatenate(([0], edge))
    ends = np.concatenate((edge, [len(ids)]))
    good = known[starts] & (ends - starts >= shortest)
    keep = np.zeros(len(ids) + 1, np.int64)
    keep[starts[good]] += 1
    keep[ends[good]] -= 1
    return np.flatnonzero(np.cumsum(keep[:-1]))


def hits(texts: list[bytes], windows: Windows) -> list[tuple[int, list[tuple[int, int]], list[int]]]:
    """Per text: number of words, merged spans of hit words, numbers of the items found."""
    get = windows.number.get
    found = [words_of(t) for t in texts]
    counts = np.fromiter(map(len, found), np.int64, len(found))
    out: list = [(int(n), [], []) for n in counts]
    total = int(counts.sum())
    if not total or not len(windows.lengths):
        return out
    ids = np.fromiter((get(w, 0) for ws in found for w in ws), np.int64, total)
    owner = np.repeat(np.arange(len(found)), counts)
    places = _runs(ids, owner, windows.shortest)
    if not len(places):
        return out
    # Separators (1) stand wherever kept words are not neighbours in one document.
    gap = np.flatnonzero((np.diff(places) != 1) | (np.diff(owner[places]) != 0)) + 1
    symbols = np.insert(ids[places], gap, 1)
    place_of = np.insert(places, gap, -1)
    present = np.zeros(len(windows.number) + 2, bool)
    present[symbols] = True
    present[0] = True  # the padding of short windows
    chosen = np.flatnonzero(present[windows.padded].all(axis=1))
    if not len(chosen):
        return out
    index = FmIndex(symbols)
    low, high = index.search(windows, chosen)
    hit = np.flatnonzero(low < high)
    sizes = (high - low)[hit]
    which = np.repeat(chosen[hit], sizes)
    rows = np.repeat(low[hit] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
    at = place_of[index.locate(rows)]
    cover = np.zeros(total + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + windows.lengths[which], -1)
    covered = np.cumsum(cover[:-1]) > 0
    first = np.concatenate(([0], np.cumsum(counts)))
    for doc in np.unique(owner[at]).tolist():
        inside = covered[first[doc] : first[doc + 1]].astype(np.int8)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], inside, [0]))))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
        out[doc] = (out[doc][0], spans, [])
    for doc, w in set(zip(owner[at].tolist(), which.tolist(), strict=True)):
        a, b = windows.first_item[w], windows.first_item[w + 1]
        out[doc][2].extend(windows.item_of[a:b].tolist())
    return out


def _groups(benchmark: DataFrame, key: str, text: str, window_words: int) -> Iterator[Windows]:
    """The test items in groups of bounded size, read from the table as a stream of rows."""
    rows = benchmark.select(
        F.col(f"`{key}`").cast("string"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    )
    group: list[tuple[str | None, list[bytes]]] = []
    size = 0
    for name, content in rows.toLocalIterator():
        words = words_of(content.encode())
        # A longer item goes in parts that share all but one word of a window.
        step = GROUP_WORDS - window_words + 1
        for at in range(0, max(len(words) - window_words + 1, min(len(words), 1)), step):
            part = words[at : at + GROUP_WORDS]
            group.append((name, part))
            size += len(part)
            if size >= GROUP_WORDS:
                yield Windows(group, window_words)
                group, size = [], 0
    if group:
        yield Windows(group, window_words)


def contamination(
    df: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window_words: int = WINDOW_WORDS,
    carry: list[str] | None = None,
    remove: bool = False,
) -> DataFrame:
    """Per row: the columns in ``carry`` (all of the input's by default) and n_words, spans (start
    and end of runs of hit words), items (ids found). Input columns of these three names give way.
    With ``remove`` the text comes without the spans.
    """
    result = ("n_words", "spans", "items")
    base = df.drop(*result)
    carry = [c for c in (carry if carry is not None else base.columns) if c not in result]
    found = None
    groups = _groups(benchmark, item_key, item_text, window_words)
    now = next(groups, Windows([], window_words))
    while now is not None:
        later = next(groups, None)
        columns = carry if later is None else sorted({*carry, text})
        cuts = remove and later is None
        found = _searched(base if found is None else found, text, now, columns, found is None, cuts)
        now = later
    return found


def _searched(
    df: DataFrame, text: str, windows: Windows, carry: list[str], first: bool, cuts: bool
) -> DataFrame:
    """One pass over the documents; a later pass unites its hits with those carried along."""
    sent = df.sparkSession.sparkContext.broadcast(windows)  # GROUP_WORDS bounds it
    span = T.StructType().add("start", "long").add("end", "long")
    schema = T.StructType([df.schema[c] for c in carry])
    schema = schema.add("n_words", "long").add("spans", T.ArrayType(span)).add("items", T.ArrayType(T.StringType()))
    arrow_span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        here = sent.value
        rows = hits([t or b"" for t in text_bytes(block.column(text))], here)
        spans = [[{"start": a, "end": b} for a, b in r[1]] for r in rows]
        items = [sorted({here.items[i] for i in r[2]} - {None}) for r in rows]
        if not first:
            old_spans, old_items = block.column("spans").to_pylist(), block.column("items").to_pylist()
            spans = [united(a + b) for a, b in zip(spans, old_spans, strict=True)]
            items = [sorted({*a, *b}) for a, b in zip(items, old_items, strict=True)]
        columns = [block.column(n) for n in carry]
        if cuts and text in carry:
            kept = [cut(t, s) if s else t for t, s in zip(block.column(text).to_pylist(), spans, strict=True)]
            columns[carry.index(text)] = pa.array(kept, pa.string())
        columns += [
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array(spans, pa.list_(arrow_span)),
            pa.array(items, pa.list_(pa.string())),
        ]
        return pa.RecordBatch.from_arrays(columns, [*carry, "n_words", "spans", "items"])

    return df.mapInArrow(by_block(work, text), schema)


def united(spans: list[dict]) -> list[dict]:
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: (s["start"], s["end"])):
        if out and s["start"] <= out[-1]["end"]:
            out[-1] = {"start": out[-1]["start"], "end": max(out[-1]["end"], s["end"])}
        else:
            out.append(dict(s))
    return out


def cut(text: str, spans: list[dict]) -> str:
    """The text without the hit words and what stands between them."""
    raw = text.encode()
    places = [m.span() for m in _WORD.finditer(raw.lower())]
    out, at = [], 0
    for s in spans:
        out.append(raw[at : places[s["start"]][0]])
        at = places[s["end"] - 1][1]
    out.append(raw[at:])
    return b"".join(out).decode()


def report(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda t, s: t + s["end"] - s["start"])
    return found.select(
        F.col(key).alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )

