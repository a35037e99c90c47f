"""Best-fit packing by bin completion, planned over lengths and carried out by rank.

Pieces of equal length are interchangeable, so the plan needs only how many pieces each length
has: at most ``capacity`` numbers, however many documents there are. ``plan`` works on that
histogram; a filling applies to as many sequences at once as its rarest length allows.

- The incumbent is best-fit decreasing.
- If it does not meet the lower bound on the number of sequences, bin completion looks for
  better: around the largest length left, it enumerates the undominated fillings (none of whose
  members could give way to a longer length that is left and still fits), least waste first, all
  within the waste that one sequence fewer than the incumbent leaves, and each any number of
  times. It ends at the lower bound, when nothing is left to try, or after undoing ``NODES``
  choices; the incumbent stands otherwise.

Each piece then finds its place by its rank among the pieces of its length: ranks are counted
within hash buckets of the pieces, so that a length which many pieces share is not one task's
work, and looked up in the plan, which has under ``capacity ** 2`` rows and is sent to all tasks.

Rows: a null or empty text is one piece with the end id alone; repeated rows are packed each;
null keys are kept; an empty table gives an empty plan.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from operator import neg

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import blocks, keyed_text, merged, written
from ledgerline.llm.tokens import VOCABULARY, vocabulary_path, word_ids

CAPACITY = 4096
END_ID = 1
#: Choices that bin completion may undo before the incumbent stands.
NODES = 4_000
#: Open choices whose fillings are held (2 MB each); older ones are enumerated again if needed.
_OPEN = 16

#: A filling: its lengths from the longest down, and the number of sequences that have it.
Filling = tuple[tuple[int, ...], int]


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[Filling]:
    """Each length, from the longest, goes to the fullest sequences that still take it."""
    open_: dict[int, Counter] = {}  # room left -> fillings with their numbers
    for length in sorted(counts, reverse=True):
        left = counts[length]
        for room in sorted(r for r in open_ if r >= length):
            if not left:
                break
            each = room // length
            for filling, n in sorted(open_[room].items(), reverse=True):
                full = min(n, left // each)
                moves = [(full, each), (1, left - full * each)] if full < n and left < n * each else [(full, each)]
                for sequences, copies in moves:
                    if sequences and copies:
                        open_[room][filling] -= sequences
                        open_.setdefault(room - copies * length, Counter())[
                            filling + (length,) * copies
                        ] += sequences
                        left -= sequences * copies
                if not left:
                    break
            open_[room] = +open_[room]
        if left:
            each = capacity // length
            if left // each:
                open_.setdefault(capacity - each * length, Counter())[(length,) * each] += left // each
            if left % each:
                rest = left % each
                open_.setdefault(capacity - rest * length, Counter())[(length,) * rest] += 1
    return sorted(((f, n) for c in open_.values() for f, n in c.items() if n), reverse=True)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """No packing has fewer sequences: by total length, and by lengths that exclude each other."""
    many = np.zeros(capacity + 2, np.int64)
    for length, n in counts.items():
        many[length] = n
    number = np.concatenate(([0], np.cumsum(many)))  # number[k]: pieces shorter than k
    total = np.concatenate(([0], np.cumsum(many * np.arange(capacity + 2))))
    half = capacity // 2 + 1  # from here on, two do not share a sequence
    small = np.arange(half)  # pieces shorter than this are left out of account
    long_ = number[capacity + 1] - number[half]
    shared = number[capacity - small + 1] - number[half]
    room = shared * capacity - (total[capacity - small + 1] - total[half])
    rest = np.maximum(0, total[half] - total[small] - room)
    return int(max(-(-total[-1] // capacity), (long_ + -(-rest // capacity)).max()))


def fillings(counts: dict[int, int], first: int, room: int, waste: int) -> Iterator[tuple[int, ...]]:
    """Undominated fillings of ``room`` beside the largest length, least waste first, one by one.

    No choice is made that leaves more than ``waste``: ``reach[i]`` has a bit for each sum that the
    lengths from the i-th on can make.
    """
    lengths = sorted((k for k, n in counts.items() if k <= room and n > (k == first)), reverse=True)
    left = [counts[k] - (k == first) for k in lengths]
    mask = (1 << (room + 1)) - 1
    reach = [1] * (len(lengths) + 1)
    for i in range(len(lengths) - 1, -1, -1):
        sums, copies, step = reach[i + 1], min(left[i], room // lengths[i]), 1
        while copies:
            taken = min(step, copies)
            sums |= sums << taken * lengths[i] & mask
            copies, step = copies - taken, step * 2
        reach[i] = sums

    def search(at: int, need: int, unused: int, slack: int) -> Iterator[tuple[int, ...]]:
        """Choices from the ``at``-th length on that make ``need``, where ``slack`` stays free.

        ``unused`` is the shortest length passed over so far: it takes the place of a length that
        is at most ``slack`` shorter, and the free room itself if it is no longer than that.
        """
        if not need:
            if not slack or at == len(lengths) or lengths[-1] > slack:
                yield ()
            return
        i = at + bisect_left(lengths[at:], -need, key=neg)
        if i > at:
            unused = lengths[i - 1]
        while i < len(lengths) and reach[i] >> need & 1 and unused > slack:
            length = lengths[i]
            for n in range(min(left[i], need // length) if unused > length + slack else 0, 0, -1):
                if reach[i + 1] >> need - n * length & 1:
                    passed = length if n < left[i] else unused
                    if passed > slack:
                        for rest in search(i + 1, need - n * length, passed, slack):
                            yield (length,) * n + rest
            unused = length
            i += 1

    for slack in range(min(waste, room) + 1):
        if reach[0] >> room - slack & 1:
            yield from search(0, room - slack, room + first + slack + 1, slack)


def complete(counts: dict[int, int], capacity: int, target: int, nodes: int) -> list[Filling] | None:
    """A packing into ``target`` sequences, if the search finds one before undoing ``nodes`` choices.

    Around one largest length, fillings are taken in the order of ``fillings`` only, each any number
    of times from the most down to one.
    """
    spare = target * capacity - sum(k * n for k, n in counts.items())
    left = {k: n for k, n in sorted(counts.items(), reverse=True) if n}
    done: list[Filling] = []

    def choices(after: Filling | None, other: bool) -> Iterator[Filling]:
        """Those behind ``after``: of other fillings only, or of fewer of its filling first."""
        first = next(iter(left))
        start = _order(after[0], capacity) if after and after[0][0] == first else ()
        for rest in fillings(left, first, capacity - first, spare):
            filling = (first, *rest)
            place = _order(filling, capacity)
            if place < start or (place == start and other):
                continue
            waste = capacity - sum(filling)
            times = min(left[k] // m for k, m in Counter(filling).items())
            times = min(times, spare // waste) if waste else times
            for n in range(after[1] - 1 if place == start else times, 0, -1):
                yield filling, n

    def move(taken: Filling, sign: int) -> None:
        nonlocal spare, left
        added = False
        for k, m in Counter(taken[0]).items():
            added |= k not in left
            left[k] = left.get(k, 0) + sign * m * taken[1]
            if not left[k]:
                del left[k]
        if added:
            left = dict(sorted(left.items(), reverse=True))
        spare += sign * (capacity - sum(taken[0])) * taken[1]

    stack: list[Iterator[Filling] | None] = []
    while left:
        if len(stack) >= _OPEN:
            stack[-_OPEN] = None
        # Behind the choice before, another number of the same filling would be that choice again.
        stack.append(choices(done[-1] if done else None, True))
        while (taken := next(stack[-1], None)) is None:
            stack.pop()
            if not stack or not nodes:
                return None
            nodes -= 1
            undone = done.pop()
            move(undone, 1)
            if stack[-1] is None:
                stack[-1] = choices(undone, False)
        done.append(taken)
        move(taken, -1)
    return done


def _order(filling: tuple[int, ...], capacity: int) -> tuple[int, ...]:
    """The place of a filling in the order of ``fillings``."""
    return (capacity - sum(filling), *(-k for k in filling))


def plan(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> list[Filling]:
    """Fillings that use each length as often as it is counted."""
    best = best_fit_decreasing(counts, capacity)
    used, least = sum(n for _, n in best), lower_bound(counts, capacity)
    while used > least:
        better = complete(counts, capacity, least, nodes) or complete(counts, capacity, used - 1, nodes)
        if better is None:
            break
        best, used = better, sum(n for _, n in better)
    return best


def _places(found: list[Filling]) -> np.ndarray:
    """Rows (length, first rank, first sequence, copies in a sequence, first offset), in order."""
    rows, ranks, sequence = [], Counter(), 0
    for filling, times in found:
        offset = 0
        for length, copies in sorted(Counter(filling).items(), reverse=True):
            rows.append((length, ranks[length], sequence, copies, offset))
            ranks[length] += copies * times
            offset += copies * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pieces(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_ids(vocabulary_path(vocabulary))
        for block in blocks(batches):
            ids, counts = table.encode(block.column("text"), end_id)
            ids = ids.astype("<u4")
            n = -(-counts // capacity)
            owner = np.repeat(np.arange(len(counts)), n)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(capacity, counts[owner] - start)
            at = (np.cumsum(counts) - counts)[owner] + start
            crc = [zlib.crc32(ids[a : a + k]) for a, k in zip(at.tolist(), length.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id").take(pa.array(owner)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(crc, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return keyed_text(df, key, text).mapInArrow(task, schema)


def placed(cut: DataFrame, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """Per piece: its columns, sequence_id and offset. ``cut`` is read four times: pass it written."""
    spark = cut.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).alias("bucket")
    cut = cut.select("*", bucket)
    rows = cut.count()
    counted = written(cut.groupBy("length", "bucket").agg(F.count("*").alias("n")), "lengths", rows=rows)
    # One row a length, so at most ``capacity`` of them.
    histogram = counted.groupBy("length").agg(F.sum("n").alias("n")).collect()
    found = _places(plan({r["length"]: r["n"] for r in histogram}, capacity, nodes))
    sent = spark.sparkContext.broadcast(found)

    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counted.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        cut.withColumn("rank", F.row_number().over(within) - 1)
        .join(merged(base, min(rows, capacity * buckets)), ["length", "bucket"])
        .select(*[c for c in cut.columns if c != "bucket"], (F.col("base") + F.col("rank")).alias("rank"))
    )
    columns = [c for c in cut.columns if c != "bucket"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = sent.value
        most = 1 << 48  # ranks lie below it
        keys = places[:, 0] * most + places[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            row = places[np.searchsorted(keys, length * most + rank, "right") - 1]
            turn, copy = np.divmod(rank - row[:, 1], row[:, 3])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in columns),
                    pa.array(row[:, 2] + turn),
                    pa.array(row[:, 4] + copy * length),
                ],
                [*columns, "sequence_id", "offset"],
            )

    schema = ranked.drop("rank").schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(task, schema)


def packed(df: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, **settings) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return placed(written(pieces(df, key, text, capacity, **settings), "pieces"), capacity)
