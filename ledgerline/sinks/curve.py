"""Clustering by several keys at once, along a space-filling curve.

Sorted by STATE, COUNTY, CITY, a table's files are narrow in the first key and as wide as the table in
the last: a filter on CITY alone opens them all. Here every key is cut into ranges of about equal numbers of
rows, and rows are ranged and sorted by their place on a Hilbert curve through all ranges. Each file then is
narrow in every key, and a filter on any of them opens a part.

The cuts come from a sample of bounded size, as those of a range exchange do; a row's place is an expression of
comparisons, without a UDF and without a join. Values that fill several ranges take one,
and the ranges that remain are spread over all bits, so a key of two values still uses the first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.contract import quoted

#: Rows looked at to find the cuts, and ranges per key as a power of two.
SAMPLE_ROWS, BITS = 100_000, 6


def _as_columns(keys: Sequence[str | Column]) -> list[Column]:
    return [F.col(quoted(k)) if isinstance(k, str) else k for k in keys]


def key_cuts(
    df: DataFrame, keys: Sequence[str | Column], bits: int = BITS, sample_rows: int = SAMPLE_ROWS, seed: int = 7
) -> list[list]:
    """Per key the values at which a new range begins: about 2 ** bits ranges of equal numbers of rows."""
    columns = [c.alias(f"k{i}") for i, c in enumerate(_as_columns(keys))]
    chosen = df.select(*columns)
    n = chosen.count()
    if n > sample_rows:
        chosen = chosen.sample(sample_rows / n, seed)
    rows = chosen.limit(2 * sample_rows).collect()  # a sample is never twice what was asked for
    cuts = []
    for i in range(len(columns)):
        values = sorted(r[i] for r in rows if r[i] is not None)
        at = [values[len(values) * j >> bits] for j in range(1, 1 << bits)] if values else []
        cuts.append(sorted({v for v in at if v > values[0]}))
    return cuts


def _range_of(value: Column, cuts: list, bits: int) -> Column:
    """The number of a value's range, spread over all bits; NULL is in the first."""
    n = len(cuts) + 1

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit((low << bits) // n)
        middle = (low + high + 1) // 2
        return F.when(value >= F.lit(cuts[middle - 1]), between(middle, high)).otherwise(between(low, middle - 1))

    return between(0, n - 1)


def curve_place(keys: Sequence[str | Column], cuts: Sequence[list], bits: int = BITS) -> Column:
    """The place of a row on a Hilbert curve through the ranges of all keys: neighbours on the curve
    differ by one range of one key."""
    n = len(cuts)
    if n * bits > 62:
        raise ValueError("keys times bits must not exceed 62")
    ranges = [_range_of(v, at, bits).cast("bigint") for v, at in zip(_as_columns(keys), cuts, strict=True)]
    if n == 1:
        return ranges[0]
    # From the largest cube to the smallest, each is turned and mirrored as the curve enters it.
    cubes = [(1 << j, i) for j in reversed(range(1, bits)) for i in range(n)]
    turns = F.array(*[F.struct(F.lit(q).cast("bigint").alias("q"), F.lit(i).alias("i")) for q, i in cubes])

    def turned(x: Column, turn: Column) -> Column:
        below = turn["q"] - 1
        first, own = F.element_at(x, 1), F.get(x, turn["i"])
        swapped = first.bitwiseXOR(own).bitwiseAND(below)
        mirror = F.transform(x, lambda v, j: F.when(j == 0, v.bitwiseXOR(below)).otherwise(v))
        swap = F.transform(x, lambda v, j: F.when((j == 0) | (j == turn["i"]), v.bitwiseXOR(swapped)).otherwise(v))
        return F.when(own.bitwiseAND(turn["q"]) != 0, mirror).otherwise(swap)

    def place(x: Column) -> Column:
        """The Gray code of the turned ranges, their bits interleaved from the highest."""
        coded = [x[0]]
        for i in range(1, n):
            coded.append(x[i].bitwiseXOR(coded[-1]))
        last = F.lit(0).cast("bigint")
        for j in range(1, bits):
            bit = F.shiftright(coded[-1], j).bitwiseAND(F.lit(1))
            last = last.bitwiseXOR(bit * F.lit((1 << j) - 1))
        out = F.lit(0).cast("bigint")
        for i, c in enumerate(coded):
            for j in range(bits):
                bit = F.shiftright(c.bitwiseXOR(last), j).bitwiseAND(F.lit(1))
                out = out + F.shiftleft(bit, j * n + n - 1 - i)
        return out

    # A list of one, so that the turned ranges are worked out once for all their bits.
    every = F.array(F.aggregate(turns, F.array(*ranges), turned))
    return F.element_at(F.transform(every, place), 1)


def curve_clustered(
    df: DataFrame, keys: Sequence[str | Column], partitions: int, spread: Sequence[str | Column] = (),
    cuts: Sequence[list] | None = None, bits: int = BITS,
) -> DataFrame:
    """Rows ranged and sorted along the curve, ready to be written; each partition becomes one file.

    ``cuts``: those of an earlier write, so that appended files follow the same curve. ``spread``
    divides rows of one place, as in :func:`~ledgerline.sinks.tables.clustered`.
    """
    place = "_place_on_curve"
    placed = df.withColumn(place, curve_place(keys, cuts or key_cuts(df, keys, bits), bits))
    ties = _as_columns(spread) or [F.xxhash64(*[F.col(quoted(c)) for c in df.columns])]
    return placed.repartitionByRange(partitions, place, *ties).sortWithinPartitions(place).drop(place)


def file_ranges(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Per Parquet file under a path: file, n_rows, and each key's least and greatest value (``ranges``, by
    position of the key: low, high). Only the keys are read."""
    found = spark.read.option("mergeSchema", "true").parquet(path)
    ends = [c for k in keys for c in (F.min(quoted(k)).alias(f"low {k}"), F.max(quoted(k)).alias(f"high {k}"))]
    return found.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n_rows"), *ends)


def files_left(ranges: DataFrame, key: str, values: Sequence) -> DataFrame:
    """Per value: how many files a filter on ``key = value`` leaves by their ranges: value, n_files, n_left."""
    low, high = F.col(quoted(f"low {key}")), F.col(quoted(f"high {key}"))
    probes = F.explode(F.array(*[F.lit(v) for v in values])).alias("value")
    each = ranges.select(probes, low.alias("low"), high.alias("high"))
    holds = (F.col("low") <= F.col("value")) & (F.col("value") <= F.col("high"))
    return each.groupBy("value").agg(F.count(F.lit(1)).alias("n_files"), F.count_if(holds).alias("n_left"))


def pruning_report(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Per key: key, n_files, mean_left, most_left over filters on values spread evenly over its rows."""
    ranges = file_ranges(spark, path, keys)
    cuts = key_cuts(spark.read.option("mergeSchema", "true").parquet(path), keys)
    parts = [
        files_left(ranges, k, at).agg(
            F.lit(k).alias("key"), F.max("n_files").alias("n_files"),
            F.avg("n_left").alias("mean_left"), F.max("n_left").alias("most_left"),
        )
        for k, at in zip(keys, cuts, strict=True) if at
    ]
    if not parts:
        return spark.createDataFrame([], "key string, n_files bigint, mean_left double, most_left bigint")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
