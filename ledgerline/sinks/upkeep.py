"""How well a clustered table's files lie after appends, and bringing only those that overlap in order.

A file covers the range from its first to its last cluster key (all keys, in order). Freshly written files
follow each other; appended ones lie across them, and a filter then opens several where one held the rows. The
depth at a key is the number of files that cover it. A sweep over the files' ends finds depth and
groups of overlapping files; :func:`recluster` rewrites the groups that are too deep, and no other
file is opened or touched. Files that only share an end do not overlap: rows of one key may fill many.

The sweep sorts one row for each end of a file in one task; rows are moved by Spark's ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.contract import quoted
from ledgerline.scratch import scratch_path
from ledgerline.sinks.replacement import Replacement
from ledgerline.sinks.tables import BYTES_PER_FILE, range_partitions


def file_spans(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Per file: file, n_rows, n_bytes, and low and high, its first and last key (a struct, NULL first)."""
    found = spark.read.option("mergeSchema", "true").parquet(path)
    key = F.struct(*[F.col(quoted(k)) for k in keys])
    return found.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("_metadata.file_size").alias("n_bytes"),
        F.min(key).alias("low"), F.max(key).alias("high"),
    )


def overlap_groups(spans: DataFrame) -> DataFrame:
    """The spans with ``group``, a number for files that overlap directly or through others, and ``depth``, the
    most files that lie on each other anywhere in the group."""
    by_low = Window.orderBy("low", "high", "file")
    reach = F.max("high").over(by_low.rowsBetween(Window.unboundedPreceding, -1))
    starts = (reach.isNull() | (F.col("low") >= reach)).cast("int")
    grouped = spans.withColumn("starts", starts).withColumn("group", F.sum("starts").over(by_low)).drop("starts")
    # At one key, files end before others begin; a file of a single key counts where it lies, and files of
    # the same single key count once.
    single = F.col("low") == F.col("high")
    ends = grouped.select(
        "group",
        F.inline(
            F.when(single, F.array(F.struct(F.col("low").alias("at"), F.lit(1).alias("turn"), F.lit(0).alias("step"))))
            .otherwise(
                F.array(
                    F.struct(F.col("low").alias("at"), F.lit(2).alias("turn"), F.lit(1).alias("step")),
                    F.struct(F.col("high").alias("at"), F.lit(0).alias("turn"), F.lit(-1).alias("step")),
                )
            )
        ),
    )
    sweep = Window.partitionBy("group").orderBy("at", "turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    depth = F.sum("step").over(sweep) + (F.col("turn") == 1).cast("int")
    deepest = ends.withColumn("depth", depth).groupBy("group").agg(F.max("depth").alias("depth"))
    return grouped.join(deepest, "group")


def depth_report(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """One row: n_files, n_overlapping (files that share more than an end with another), max_depth, and
    mean_depth, the depth of each group weighted by its rows."""
    found = overlap_groups(file_spans(spark, path, keys))
    sizes = found.groupBy("group").agg(
        F.count(F.lit(1)).alias("n"), F.max("depth").alias("depth"), F.sum("n_rows").alias("rows")
    )
    return sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_files"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("n_overlapping"),
        F.coalesce(F.max("depth"), F.lit(0)).alias("max_depth"),
        (F.sum(F.col("depth") * F.col("rows")) / F.sum("rows")).alias("mean_depth"),
    )


def recluster(
    spark: SparkSession, path: str, keys: Sequence[str], deepest: int = 1, bytes_per_file: int = BYTES_PER_FILE
) -> int:
    """Rewrite the groups of files whose depth is more than ``deepest``; returns how many files were replaced.

    The new files are written beside the table and put in place together; if that fails, the
    old ones are put back. Rows keep their group, so no new file reaches across a file that stays.
    """
    groups = scratch_path(spark, "overlaps")
    overlap_groups(file_spans(spark, path, keys)).where(F.col("depth") > deepest).select(
        F.col("file").alias("_file"), F.col("group").alias("_group"), "n_bytes"
    ).write.parquet(groups)
    chosen = spark.read.parquet(groups)
    files = [r["_file"] for r in chosen.select("_file").collect()]  # the names of what is to be replaced
    if not files:
        return 0
    n_bytes = chosen.agg(F.sum("n_bytes")).first()[0]
    found = spark.read.option("mergeSchema", "true").parquet(path)
    rows = found.select("*", F.col("_metadata.file_path").alias("_file")).where(F.col("_file").isin(files))
    by = ["_group", *keys]
    columns = [F.col(quoted(c)) for c in by]
    ties = F.xxhash64(*[F.col(quoted(c)) for c in found.columns])
    ranged = (
        rows.join(chosen.select("_file", "_group"), "_file").drop("_file")
        .repartitionByRange(range_partitions(spark, n_bytes, bytes_per_file), *columns, ties)
        .sortWithinPartitions(*columns)
    )
    with Replacement(spark) as replaced:
        ranged.write.partitionBy("_group").parquet(replaced.files(path, files))
    spark.catalog.refreshByPath(path)
    return len(files)
