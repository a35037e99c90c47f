"""Keyed snapshots in hash buckets, so that a merge reads and writes only what it changes.

A snapshot holds one row for each key. Its rows lie in buckets by the hash of the key, and each bucket has a
Bloom filter of its keys. A merge

1. asks the filters which incoming keys a bucket may hold; the others are new for certain;
2. reads key and order of the buckets that may hold some, and tells modified from stale records;
3. rewrites the buckets with modified records, adds a folder to those with new ones alone, and leaves all
   others as they are.

Every merge writes folders of its own, and last a line for each bucket it touched: these lines, put in place
by one rename, make it count. A merge that fails leaves the snapshot as it was. A bucket consists of the
folder that last rewrote it and those added since; one with many is rewritten by the next merge that
adds to it. :func:`vacuum` removes folders that no longer count.

A filter is a row for each 32,768 bits of a bucket (a key's bits all lie in one of them), built and joined
by Spark's bitmap aggregates; no filter and no key passes the driver, which sees one line for each bucket.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.contract import quoted
from ledgerline.operators.incremental import latest_per_key
from ledgerline.scratch import discard, scratch_path
from ledgerline.sinks.replacement import Replacement
from ledgerline.sinks.tables import rebalanced

#: Bits of one row of a filter (what Spark's bitmap functions hold), and bits set for each key.
SEGMENT_BITS, HASHES = 32768, 7
#: Folders of a bucket from which on it is rewritten instead of added to.
MOST_FOLDERS = 8

_LINE = "_merge bigint, bucket int, rewritten boolean, n_rows bigint"


@dataclass(frozen=True)
class MergeMetrics:
    """What a merge met and touched."""

    n_new: int
    n_modified: int
    n_stale: int
    rewritten: tuple[int, ...]
    added_to: tuple[int, ...]
    n_buckets: int

    @property
    def n_untouched(self) -> int:
        return self.n_buckets - len(self.rewritten) - len(self.added_to)

    def counts(self) -> dict[str, int]:
        return {"n_new": self.n_new, "n_modified": self.n_modified, "n_stale": self.n_stale}


@dataclass(frozen=True)
class Layout:
    """How a snapshot is laid out; written once, when it is created."""

    key: list[str]
    order: list[str]
    n_buckets: int
    n_segments: int
    schema: T.StructType


def _cols(names: list[str], prefix: str = "") -> list[Column]:
    return [F.col(quoted(prefix + n)) for n in names]


def _layout(spark: SparkSession, path: str) -> Layout:
    row = spark.read.parquet(f"{path}/layout").first()
    schema = T.StructType.fromJson(json.loads(row["schema"]))
    return Layout(row["key"], row["order"], row["n_buckets"], row["n_segments"], schema)


def _bucket(layout: Layout) -> Column:
    return F.pmod(F.xxhash64(*_cols(layout.key)), F.lit(layout.n_buckets)).cast("int")


def _bits(layout: Layout) -> tuple[Column, Column]:
    """The filter row of a key within its bucket, and the places of its bits there."""
    place = F.xxhash64(F.lit(1), *_cols(layout.key))
    step = F.xxhash64(F.lit(2), *_cols(layout.key))
    first, further = step.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(step, 32)
    places = [F.pmod(first + further * i, F.lit(SEGMENT_BITS)) for i in range(HASHES)]
    return F.pmod(place, F.lit(layout.n_segments)).cast("int"), F.array(*places)


def _filters(rows: DataFrame, layout: Layout) -> DataFrame:
    """The filter rows of rows with their ``_bucket``: _bucket, segment, bits."""
    segment, places = _bits(layout)
    set_bits = rows.select("_bucket", segment.alias("segment"), F.explode(places).alias("place"))
    return set_bits.groupBy("_bucket", "segment").agg(F.bitmap_construct_agg("place").alias("bits"))


def _held(bits: Column, places: Column) -> Column:
    """Whether all places are set in a filter row."""

    def one(place: Column) -> Column:
        byte = F.conv(F.hex(F.substring(bits, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        turned = F.call_function("shiftright", byte, place.bitwiseAND(F.lit(7)).cast("int"))
        return turned.bitwiseAND(F.lit(1)) == 1

    return F.forall(places, one)


def _write(rows: DataFrame, layout: Layout, path: str, merge: int, rewritten: list[int]) -> None:
    """One merge's folders: rows, their filters, and the lines that make them count."""
    spark = rows.sparkSession
    with Replacement(spark) as replaced:
        at = replaced.path(f"{path}/rows/_merge={merge}")
        rebalanced(rows, ["_bucket"]).write.partitionBy("_bucket").parquet(at)
        schema = T.StructType([*layout.schema.fields, T.StructField("_bucket", T.IntegerType())])
        written = spark.read.schema(schema).parquet(at)
        _filters(written, layout).write.parquet(replaced.path(f"{path}/filters/_merge={merge}"))
        counts = written.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n_rows"))
        lines = counts.select(
            F.col("_bucket").alias("bucket"), F.col("_bucket").isin(rewritten).alias("rewritten"), "n_rows"
        )
        lines.write.parquet(replaced.path(f"{path}/lines/_merge={merge}"))


def _live(spark: SparkSession, path: str) -> DataFrame:
    """The folders that count: _merge, bucket, n_rows."""
    lines = spark.read.schema(T.StructType.fromDDL(_LINE)).parquet(f"{path}/lines")
    last = lines.groupBy("bucket").agg(F.max(F.when(F.col("rewritten"), F.col("_merge"))).alias("last"))
    both = lines.join(last, "bucket")
    return both.where(F.col("_merge") >= F.coalesce("last", F.lit(0))).select("_merge", "bucket", "n_rows")


def _read(spark: SparkSession, path: str, layout: Layout, folders: list[tuple[int, int]]) -> DataFrame:
    """Rows of some folders (merge, bucket), with ``_bucket``; no other folder is listed."""
    schema = T.StructType([*layout.schema.fields, T.StructField("_bucket", T.IntegerType())])
    if not folders:
        return spark.createDataFrame([], schema)
    places = [f"{path}/rows/_merge={m}/_bucket={b}" for m, b in sorted(folders)]
    found = spark.read.schema(schema).option("basePath", f"{path}/rows").parquet(*places)
    return found.select(*_cols(schema.names))


def create_snapshot(
    df: DataFrame, path: str, key: list[str], order: list[str], n_buckets: int, bits_per_key: int = 10
) -> None:
    """A snapshot of the latest record per key (greatest ``order``, NULL lowest).

    Choose ``n_buckets`` for some 128 MB each; filters take ``bits_per_key`` for each row of now.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    rows = scratch_path(spark, "snapshot")
    latest_per_key(df, key, order).write.parquet(rows)
    latest = spark.read.schema(df.schema).parquet(rows)
    n_segments = max(1, -(-latest.count() * bits_per_key // (n_buckets * SEGMENT_BITS)))
    layout = Layout(key, order, n_buckets, n_segments, latest.schema)
    _write(latest.withColumn("_bucket", _bucket(layout)), layout, path, 1, list(range(n_buckets)))
    schema = "key array<string>, order array<string>, n_buckets int, n_segments int, schema string"
    told = spark.createDataFrame([(key, order, n_buckets, n_segments, latest.schema.json())], schema)
    told.coalesce(1).write.parquet(f"{path}/layout")
    discard(spark, rows)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """One row for each key."""
    path = path.rstrip("/")
    folders = [(r["_merge"], r["bucket"]) for r in _live(spark, path).collect()]
    return _read(spark, path, _layout(spark, path), folders).drop("_bucket")


def merge_into_snapshot(spark: SparkSession, path: str, incoming: DataFrame) -> MergeMetrics:
    """Bring a snapshot up to date with incoming records.

    Of several records for a key the latest counts; against the held one it wins on an equal order. The
    columns are the snapshot's, by name.
    """
    path = path.rstrip("/")
    layout = _layout(spark, path)
    live = [(r["_merge"], r["bucket"]) for r in _live(spark, path).collect()]
    fresh = _fresh(layout, incoming)
    if fresh.isEmpty():
        return MergeMetrics(0, 0, 0, (), (), layout.n_buckets)
    told_at = scratch_path(spark, "merge")
    _told(spark, path, layout, fresh, live).write.parquet(told_at)
    told = spark.read.parquet(told_at)
    count = lambda status: F.count_if(F.col("_status") == status).alias(status)
    met = told.groupBy("_bucket").agg(*[count(s) for s in ("new", "modified", "stale")]).collect()
    folders: dict[int, int] = {}
    for _, bucket in live:
        folders[bucket] = folders.get(bucket, 0) + 1
    changed = [r["_bucket"] for r in met if r["modified"]]
    full = [r["_bucket"] for r in met if r["new"] and not r["modified"] and folders.get(r["_bucket"], 0) >= MOST_FOLDERS]
    rewritten = sorted(changed + full)
    added_to = sorted({r["_bucket"] for r in met if r["new"]} - set(rewritten))
    if rewritten or added_to:
        fresh = told.where("_status <> 'stale'").drop("_status")
        stay = _read(spark, path, layout, [f for f in live if f[1] in set(rewritten)])
        gone = told.where("_status = 'modified'").select(*[F.col(quoted(k)).alias(f"_gone_{i}") for i, k in enumerate(layout.key)])
        same = [F.col(quoted(k)).eqNullSafe(F.col(f"_gone_{i}")) for i, k in enumerate(layout.key)]
        rows = stay.join(gone, same, "left_anti").unionByName(fresh)
        last = spark.read.schema(T.StructType.fromDDL(_LINE)).parquet(f"{path}/lines").agg(F.max("_merge")).first()[0]
        _write(rows, layout, path, last + 1, rewritten)
    discard(spark, told_at)
    total = lambda status: sum(r[status] for r in met)
    return MergeMetrics(
        total("new"), total("modified"), total("stale"), tuple(rewritten), tuple(added_to), layout.n_buckets
    )


def _fresh(layout: Layout, incoming: DataFrame) -> DataFrame:
    """The latest incoming record per key, written once, with its bucket and the places of its bits."""
    spark = incoming.sparkSession
    typed = incoming.select(*[F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in layout.schema.fields])
    segment, places = _bits(layout)
    fresh = latest_per_key(typed, layout.key, layout.order).withColumns(
        {"_bucket": _bucket(layout), "_segment": segment, "_places": places}
    )
    fresh_at = scratch_path(spark, "incoming")
    fresh.write.parquet(fresh_at)
    return spark.read.schema(fresh.schema).parquet(fresh_at)


def _told(spark: SparkSession, path: str, layout: Layout, fresh: DataFrame, live: list[tuple[int, int]]) -> DataFrame:
    """Incoming records with ``_bucket`` and ``_status``: new, modified or stale."""
    pairs = spark.createDataFrame(live, "_merge bigint, _bucket int")
    filters = spark.read.schema("_merge bigint, _bucket int, segment int, bits binary").parquet(f"{path}/filters")
    filters = (
        filters.join(pairs, ["_merge", "_bucket"], "left_semi")
        .groupBy("_bucket", F.col("segment").alias("_segment"))
        .agg(F.bitmap_or_agg("bits").alias("_filter"))
    )
    maybe = F.coalesce(_held(F.col("_filter"), F.col("_places")), F.lit(False))
    asked = fresh.join(filters, ["_bucket", "_segment"], "left").withColumn("_maybe", maybe).drop("_filter", "_places", "_segment")
    asked_at = scratch_path(spark, "asked")
    asked.write.parquet(asked_at)
    asked = spark.read.parquet(asked_at)
    hit = {r["_bucket"] for r in asked.where("_maybe").select("_bucket").distinct().collect()}
    held = _read(spark, path, layout, [f for f in live if f[1] in hit]).select(
        *[F.col(quoted(k)).alias(f"_held_{i}") for i, k in enumerate(layout.key)],
        F.struct(*_cols(layout.order)).alias("_held"),
    )
    same = F.col("_maybe")
    for i, k in enumerate(layout.key):
        same = same & F.col(quoted(k)).eqNullSafe(F.col(f"_held_{i}"))
    newer = F.struct(*_cols(layout.order)) >= F.col("_held")
    status = F.when(F.col("_held").isNull(), "new").when(newer, "modified").otherwise("stale")
    told = asked.join(held, same, "left").withColumn("_status", status)
    return told.select(*_cols(layout.schema.names), "_bucket", "_status")


def bucket_report(spark: SparkSession, path: str) -> DataFrame:
    """Per bucket: the folders that count and their rows."""
    live = _live(spark, path.rstrip("/"))
    return live.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_folders"), F.sum("n_rows").alias("n_rows"))


def vacuum(spark: SparkSession, path: str) -> int:
    """Remove the folders that no longer count; returns their number. Readers of older merges fail."""
    path = path.rstrip("/")
    live = _live(spark, path).select("_merge", "bucket")
    lines = spark.read.schema(T.StructType.fromDDL(_LINE)).parquet(f"{path}/lines")
    dead = lines.join(live, ["_merge", "bucket"], "left_anti").select("_merge", "bucket").collect()
    discard(spark, *[f"{path}/rows/_merge={r['_merge']}/_bucket={r['bucket']}" for r in dead])
    return len(dead)
