"""SimHash near-duplicates through a segment-popcount embedding.

Each document gets a 64-bit SimHash of its word shingles. A fingerprint is mapped to the bit
counts of its eight bytes, a point in a grid. Flipping one bit moves that point by one step, so
the Manhattan distance of two points never exceeds the Hamming distance of the fingerprints:
all links lie between grid cells at Manhattan distance of at most ``max_bits``. The join of
cells in that range proposes pairs, the bit count of the exclusive-or verifies each exactly.

Equal fingerprints meet before the join (partial aggregation), so a group of copies is one
point whatever its size. Components are found by alternating star contractions over written
edges.

Rows: a null text is an empty one; a text without words has fingerprint zero and links like any
other; repeated rows come back as often as they came in; a null key keeps its row, and is never a
component's name unless no other document is in the component (then that is null).
"""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import by_block, keyed_text, merged, text_bytes, written

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Shingles whose bits are counted at a time within one text.
_AT_ONCE = 1 << 18


def simhash(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of one text: a bit is set if it is set in over half the shingles' hashes."""
    words = text.lower().split()  # on bytes: only A-Z, and only ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle_words, len(words))
    starts, ends = starts[: len(words) - k + 1], ends[k - 1 :]
    digest, seed = xxhash.xxh64_intdigest, SEED
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), _AT_ONCE):
        pairs = zip(starts[at : at + _AT_ONCE].tolist(), ends[at : at + _AT_ONCE].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], seed) for a, b in pairs], ">u8")
        bits = np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big")


def fingerprints(
    df: DataFrame, key: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS, carry: tuple = ()
) -> DataFrame:
    """Per row: doc_id, bits (the fingerprint as a signed long), and the columns named in ``carry``."""
    rows = keyed_text(df, key, text) if not carry else df.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
        *carry,
    )
    schema = rows.drop("text").schema.add("bits", "long")

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        found = [simhash(t, shingle_words) for t in text_bytes(block.column("text"))]
        bits = np.array(found, np.uint64).view(np.int64)
        columns = [block.column(n) for n in schema.names[:-1]]
        return pa.RecordBatch.from_arrays([*columns, pa.array(bits)], schema.names)

    return rows.mapInArrow(by_block(work), schema)


def _steps(reach: int) -> list[int]:
    """Moves in the grid by at most ``reach`` steps, one of each opposite pair, as differences of
    packed cells."""
    unit = [1 << (4 * i) for i in range(8)]
    signed = unit + [-u for u in unit]
    moves = {sum(m) for n in range(reach + 1) for m in combinations_with_replacement(signed, n)}
    return sorted(m for m in moves if m >= 0)


def _cell(bits: str, margin: int):
    """The bit counts of the eight bytes, four binary digits each; the margin leaves room for
    steps below zero."""
    packed = F.lit(0).cast("long")
    for i in range(8):
        count = F.bit_count(F.shiftrightunsigned(bits, 8 * i).bitwiseAND(F.lit(255))).cast("long")
        packed = packed + F.shiftleft(count + F.lit(margin), 4 * i)
    return packed


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b) of different fingerprints of ``prints.bits`` at ``max_bits`` bits or fewer.

    ``max_bits`` up to 3: a byte's count, shifted by the margin, must fit four digits.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must lie between 0 and 3")
    cells = prints.select("bits", _cell("bits", max_bits).alias("cell"))
    steps = F.array(*[F.lit(s).cast("long") for s in _steps(max_bits)])
    probes = cells.select(F.col("bits").alias("a"), "cell", F.explode(steps).alias("step")).select(
        "a", (F.col("cell") + F.col("step")).alias("cell"), (F.col("step") == 0).alias("same")
    )
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    # Merged at any size: Spark sizes the probes as if each fingerprint had one.
    return (
        probes.hint("merge")
        .join(cells.withColumnRenamed("bits", "b"), "cell")
        .filter(near & (~F.col("same") | (F.col("a") < F.col("b"))))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )


def components(edges: DataFrame) -> DataFrame:
    """Per node that has an edge: node, root (the smallest node it reaches).

    Each round moves every edge towards the smallest neighbour, first from the larger and then
    from the smaller ends, until only stars are left. No step makes edges more.
    """
    current = written(edges.select("a", "b").distinct(), "edges")
    before = None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            stars = current.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
                current.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
            )
            return merged(stars, 2 * state[0])
        before = state
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(merged(least, 2 * state[0]), "a").filter(F.col("b") > F.col("a"))
        large = large.select(F.col("m").alias("a"), "b").distinct()
        large = written(large.filter("a <> b"), "edges", rows=state[0])
        # Now every edge goes from a smaller a to a larger b.
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        to_least = large.join(merged(least, state[0]), "b")
        small = (
            to_least.select(F.col("m").alias("a"), "b")
            .union(to_least.filter(F.col("a") != F.col("m")).select(F.col("m").alias("a"), F.col("a").alias("b")))
            .distinct()
        )
        current = written(small, "edges", rows=state[0])


def classes(prints: DataFrame, max_bits: int = MAX_BITS, rows: int | None = None) -> DataFrame:
    """The rows of ``prints``, one for each value of ``bits`` (``rows`` at most, if known), with the
    ``root`` of its component."""
    stars = components(links(prints, max_bits)).withColumnRenamed("node", "bits")
    others = [c for c in prints.columns if c != "bits"]
    named = prints.join(stars, "bits", "left").select("bits", *others, F.coalesce("root", "bits").alias("root"))
    return written(named, "simhash-classes", rows)


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """Per row: doc_id, bits, component_id (the smallest key in reach, itself included)."""
    docs = written(fingerprints(df, key, text, shingle_words), "simhash")
    rows = docs.count()
    named = classes(docs.groupBy("bits").agg(F.min("doc_id").alias("first_doc")), max_bits, rows)
    smallest = named.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    found = named.join(merged(smallest, rows), "root").select("bits", "component_id")
    return docs.join(merged(found, rows), "bits").select("doc_id", "bits", "component_id")


def as_hex(bits: str = "bits"):
    return F.lpad(F.lower(F.hex(bits)), 16, "0")
