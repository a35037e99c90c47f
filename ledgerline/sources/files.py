"""Staged Parquet files with their file names and row numbers."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _paths(path: str | list[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def _listing(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Path and length of every file under a path; no file is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.load(_paths(path)).select("path", "length")


def input_bytes(spark: SparkSession, path: str | list[str]) -> int:
    """The size of all files under a path or pattern, as its file system sums it."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for pattern in _paths(path):
        place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
        system = place.getFileSystem(conf)
        for found in system.globStatus(place) or ():
            total += system.getContentSummary(found.getPath()).getLength()
    return total


def any_longer(spark: SparkSession, path: str | list[str], n_bytes: int) -> bool:
    """Whether some file under a path is longer than ``n_bytes``."""
    if input_bytes(spark, path) <= n_bytes:
        return False
    return not _listing(spark, path).where(F.col("length") > n_bytes).isEmpty()


def read_staged(spark: SparkSession, path: str | list[str], lineage: bool = False) -> DataFrame:
    """Every Parquet file under a path, with the columns of all files.

    With ``lineage`` also file name and 1-based row number.
    """
    found = spark.read.option("mergeSchema", "true").parquet(*_paths(path))
    if not lineage:
        return found
    return found.select(
        F.col("_metadata.file_name").alias("_file"),
        (F.col("_metadata.row_index") + 1).alias("_row_number"),
        "*",
    )


def file_summary(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows and row-number range per file; no data column is read."""
    return (
        read_staged(spark, path, lineage=True)
        .groupBy("_file")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("_row_number").alias("lo"),
            F.max("_row_number").alias("hi"),
        )
    )


def inspect(spark: SparkSession, path: str | list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows by file name and row number, every column shown.

    Files are listed and the first by name taken until they hold ``n`` rows; of each only its
    first ``n`` rows are asked for, so neither other files nor later row groups are read.
    """
    name = F.element_at(F.split("path", "/"), -1)
    names = _listing(spark, path).select(name.alias("name")).orderBy("name")
    n_files = max(n, 1)
    while True:
        taken = [r["name"] for r in names.limit(n_files).collect()]
        # File names in a path are encoded, in the metadata they are not.
        first = (
            read_staged(spark, path)
            .where(F.col("_metadata.file_name").isin(sorted({unquote(t) for t in taken})))
            .where(F.col("_metadata.row_index") < n)
        )
        if len(taken) < n_files or first.limit(n).count() >= n:
            break
        n_files *= 8
    found = first.select(
        F.col("_metadata.file_name").alias("_file"),
        (F.col("_metadata.row_index") + 1).alias("_row_number"),
        F.col("_metadata.file_path").alias("_path"),
        "*",
    )
    return found.orderBy("_file", "_path", "_row_number").limit(n).drop("_path")
